"""Session helpers: the shared working folder and the layout of narrow scans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():  # with its scheme, as Spark itself resolves it
        return sc.getCheckpointDir()
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="replivote-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read from there: the planner then knows their size."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of files whose rows one task fans out by key: what they become is sorted or hashed, and should stay in memory.
SHARE = 4 << 20


def _file_bytes(scan: DataFrame) -> int:
    """Bytes of the files behind a table as far as the planner knows them, 0 for other tables."""
    leaves = scan._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)  # an unknown size is stated as an enormous one


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread the rows of a narrow file scan over the cluster before a fan-out.

    With keys, hash partitioning also serves every later grouping that includes
    them. The number of partitions is stated, and grows with the files: the rows are about to multiply, so
    their size now must not let the adaptive planner merge them. Without keys, a
    scan with two splits or more per core is left alone; below that, splits of one
    row group are mostly empty.
    """
    spark = scan.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if keys:
        shares = -(-_file_bytes(scan) // SHARE)
        return scan.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")), shares), *keys)
    return scan if scan.rdd.getNumPartitions() >= 2 * cores else scan.repartition(cores)
