"""Answers that survive a broken run: stored unit by unit, and never asked twice once stored."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.operators.annotate import annotate, status

_LOG = "part string, model string, bucket int, path string, settings string"


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """What has been stored in a folder; no rows before the first."""
    try:
        return spark.read.schema(_LOG).parquet(f"{folder}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)


def _store(df: DataFrame, folder: str, part: str, model: str | None, bucket: int | None, settings: str, by: str | None = None) -> None:
    """Write rows to a path of their own, then say so in the log; only what the log names counts."""
    path = f"{folder}/{part}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    row = df.sparkSession.createDataFrame([(part, model, bucket, path, settings)], _LOG)
    row.coalesce(1).write.mode("append").parquet(f"{folder}/log")


def pending_units(spark: SparkSession, folder: str, models: Sequence[str], buckets: int) -> DataFrame:
    """``model_idx, model, bucket`` of the units that are not stored yet."""
    units = spark.createDataFrame(list(enumerate(models)), "model_idx int, model string")
    units = units.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    done = _log(spark, folder).where("part = 'answers'").select("model", "bucket")
    return units.join(done, ["model", "bucket"], "left_anti").select("model_idx", "model", "bucket")


def annotate_resumable(
    tasks: DataFrame,
    models: Sequence[str],
    runs: int,
    open_responder: Callable,
    folder: str,
    *,
    key: str,
    keep: Sequence[str] = (),
    buckets: int = 64,
    units: int | None = None,
    pause: float = 0.0,
    **options,
) -> DataFrame:
    """Ask every model about every row, unit by unit, into ``folder``: ``key, keep, model_idx, model, run, response, status``.

    A unit is one model and one of ``buckets`` shares of the rows, dealt by a hash of the key, and is one
    Spark job over as many tasks as its rows need. It counts once the log names it, after all its
    answers are written. Called again with the same folder, a broken run asks only the units that are missing,
    about the rows that the first call stored; of ``tasks`` only the columns then matter. ``units`` ends the call early after
    so many; ``pause`` seconds pass between two models. Models take their turn one after another, as long as
    their names, ``runs`` and ``buckets`` are those of the first call; others are refused.

    Rows are stored once, by bucket, so that a unit reads its own only. Rows with a null key share a
    bucket; repeated rows are asked as often as they are there; rows with a null prompt have the status
    ``missing``. Other options are those of ``annotate``.
    """
    spark, models = tasks.sparkSession, list(models)
    if not models:
        raise ValueError("no model to ask")
    settings = f"{models} {runs} {buckets}"
    rows = _log(spark, folder).where("part = 'rows'").first()
    if rows is None:
        dealt = tasks.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        _store(dealt.repartition("_bucket", F.xxhash64(*tasks.columns) % 16), folder, "rows", None, None, settings, "_bucket")
        rows = _log(spark, folder).where("part = 'rows'").first()
    if rows["settings"] != settings:
        raise ValueError(f"this folder holds answers for {rows['settings']}, not {settings}")
    stored = spark.read.schema(T.StructType([*tasks.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(rows["path"])
    last = None
    for unit in pending_units(spark, folder, models, buckets).orderBy("model_idx", "bucket").limit(units if units is not None else len(models) * buckets).collect():
        if pause and last not in (None, unit["model"]):
            time.sleep(pause)
        last = unit["model"]
        mine = stored.where(F.col("_bucket") == unit["bucket"])
        asked = annotate(mine, [unit["model"]], runs, open_responder, key=key, **options)
        _store(asked.select(key, *keep, "answers", "failed"), folder, "answers", unit["model"], unit["bucket"], settings)
    return stored_answers(spark, folder, models, key, keep)


def stored_answers(spark: SparkSession, folder: str, models: Sequence[str], key: str, keep: Sequence[str] = ()) -> DataFrame:
    """The answers of all stored units of a folder, a row each."""
    done = _log(spark, folder).where("part = 'answers'").select("model", "path").collect()
    found = None
    for at, model in enumerate(models):
        paths = [r["path"] for r in done if r["model"] == model]
        if paths:
            own = spark.read.parquet(*paths).select(key, *keep, F.lit(at).alias("model_idx"), F.lit(model).alias("model"), "answers", "failed")
            found = own if found is None else found.unionByName(own)
    if found is None:
        raise ValueError("no unit is stored yet")
    each = found.select(key, *keep, "model_idx", "model", F.posexplode_outer(F.arrays_zip("answers", "failed")).alias("_at", "_a"))
    return each.select(
        key,
        *keep,
        "model_idx",
        "model",
        (F.col("_at") + 1).alias("run"),
        F.col("_a.answers").alias("response"),
        status(F.col("_a.answers"), F.col("_a.failed")).alias("status"),
    )
