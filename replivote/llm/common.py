"""What the operators share: tables, stored intermediate results, ASCII words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.session import fresh_path

#: Bytes of text that one task of a Python step handles at a time.
CHUNK = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder once and read from there.

    It cuts the lineage, survives lost executors, and gives the planner the size of
    the result, so that it broadcasts only what it knows to be small.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null gives an empty one."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.array_remove(parts, "")


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of one text column, a long text alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = used = 0
        for i, size in enumerate(sizes):
            if used and used + size > limit:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def per_row(
    df: DataFrame, columns: list[str], added: T.StructType, function: Callable[..., dict[str, list]], drop: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with columns computed by ``function`` from lists of the named columns.

    The function gets one list per column and returns one list per added column. Rows
    stay where they are. An added column takes the place of an input column of its name;
    columns to ``drop`` do not travel back from Python.
    """
    new = {f.name.lower() for f in added} | {c.lower() for c in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    inputs = [F.col(quoted(f.name)).alias(f"k{i}") for i, f in enumerate(kept)]
    inputs += [F.col(quoted(c)).alias(f"i{i}") for i, c in enumerate(columns)]
    schema = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(kept)] + list(added.fields))
    width, arrow = len(kept), [(f.name, _arrow(f.dataType)) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "i0"):
                out = function(*[batch.column(width + i).to_pylist() for i in range(len(columns))])
                arrays = [batch.column(i) for i in range(width)] + [pa.array(out[n], t) for n, t in arrow]
                yield pa.RecordBatch.from_arrays(arrays, [f"k{i}" for i in range(width)] + [n for n, _ in arrow])

    done = df.select(*inputs).mapInArrow(run, schema)
    return done.select(*[F.col(f"k{i}").alias(f.name) for i, f in enumerate(kept)], *added.names)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ranked(keys: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Distinct small rows numbered from 0 in a total order, without one task for all of them.

    Rows are dealt by range, numbered in each partition, and moved on by the sizes of
    the partitions before; those sizes are one row per partition.
    """
    pieces = stored(
        keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    from pyspark.sql import Window

    sizes = pieces.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return pieces.withColumn("_place", place).join(before, "_part").select(
        *keys.columns, (F.col("_place") + F.col("_before")).cast("long").alias(name)
    )
