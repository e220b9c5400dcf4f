"""Mixing sources to target weights: repeat or thin each source's documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import quoted, ranked, stored

#: Words are runs of anything but blanks and the ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def source_rates(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    ``share`` times all words. No target exceeds ``limit`` times its source's size; what
    is above is dealt anew by weight among the others until none is above. ``share``
    must not exceed ``limit``. A source without words has target and rate 0.
    """
    if share > limit:
        raise ValueError("the sources cannot hold this share within the limit")
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    sizes = docs.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(sizes, [F.col("source").asc_nulls_last()], "place")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    table = stored(placed.withColumn("weight", turn[(F.col("place") % len(weights)).cast("int")]), "sources")
    limited = table.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    total = limited.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level, above = 0.0, -1
    while total["weight"]:  # each turn fixes more sources at their limit; sums of one row come back
        full = F.col("weight") * F.lit(level) >= F.col("most")
        fixed = limited.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if fixed["n"] == above or not fixed["open"]:
            break
        above, level = fixed["n"], (share * total["size"] - fixed["taken"]) / fixed["open"]
    target = F.least(F.col("weight") * F.lit(level), F.col("most"))
    return limited.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def copies(docs: DataFrame, rates: DataFrame, key: str = "doc_id", seed: int = 20) -> DataFrame:
    """``docs`` with ``source_size, target, rate, size, copies``: how often the mix takes each document.

    A document is taken ``floor(rate)`` times and once more if a number in [0, 1),
    hashed from its key and the seed, is below the fraction of the rate; so reruns
    agree, and equal keys draw alike. Input columns of these names are replaced.
    """
    plain = docs.drop("source_size", "target", "rate", "size", "copies")
    known = rates.withColumnRenamed("source", "_source")
    joined = plain.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    draw = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    whole = F.floor("rate")
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    times = (whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)).cast("long")
    return joined.withColumns({"size": size, "copies": times})


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0, seed: int = 20) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns as they were.

    Null text counts no words and is emitted by its source's rate; a null source is a
    source of its own; an empty table gives an empty mix.
    """
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row")
    taken = copies(docs.select("doc_id", "source", "text", whole), source_rates(docs, weights, share, limit), seed=seed)
    rows = taken.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select("_row.*")
