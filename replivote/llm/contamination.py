"""Benchmark decontamination: short test items found inside long documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import ascii_lower, quoted, stored, words


def shingled(rows: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``id, grams``: the word sequences of ``width`` of each row as hashes, repeats included."""
    tokens = rows.select(F.col(key).alias("id"), words(ascii_lower(F.col(text))).alias("w"))
    hashed = tokens.select("id", F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    last = F.size("w") - width
    gram = lambda i: F.xxhash64(*[F.element_at("w", i + k) for k in range(1, width + 1)])
    return hashed.select(
        "id", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(F.array().cast("array<bigint>")).alias("grams")
    )


def positive(gram: Column) -> Column:
    """A shingle's place in the random order that sketches go by."""
    return F.pmod(F.xxhash64(gram, F.lit(77)), F.lit(1 << 62))


def sketches(items: DataFrame, width: int = 5, containment: float = 0.8) -> DataFrame:
    """``item_id, n_item, part, gram, place``: the MinHash sketch of each item.

    Items fall into parts by size, a part per power of two. A document that holds
    ``containment`` of an item's n shingles lacks at most ``n - ceil(containment n)``,
    so it holds one of the item's ``n - ceil(containment n) + 1`` smallest; the sketch
    is as long as the part's largest item needs (never longer than the item).
    """
    sets = shingled(items, "item_id", "text", width).select("id", F.array_distinct("grams").alias("grams"))
    sets = sets.where(F.col("id").isNotNull() & (F.size("grams") > 0)).groupBy("id").agg(F.flatten(F.collect_set("grams")).alias("grams"))
    sets = sets.select(F.col("id").alias("item_id"), F.array_distinct("grams").alias("grams")).withColumn("n_item", F.size("grams"))
    part = sets.withColumn("part", F.floor(F.log2("n_item")).cast("int"))
    most = F.pow(F.lit(2.0), F.col("part") + 1) - 1
    length = F.least(F.col("n_item"), (most - F.ceil(most * F.lit(containment) - 1e-9) + 1).cast("int"))
    ordered = F.array_sort(F.transform("grams", lambda g: F.struct(positive(g).alias("place"), g.alias("gram"))))
    return part.select("item_id", "n_item", "part", F.explode(F.slice(ordered, F.lit(1), length)).alias("s")).select(
        "item_id", "n_item", "part", "s.gram", "s.place"
    )


def contaminated(
    docs: DataFrame, items: DataFrame, width: int = 5, containment: float = 0.8, key: str = "doc_id"
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared``: items of which a document holds enough shingles.

    Shingles are ``width`` words (blank-separated, A-Z folded). The part of an item only
    sets the length of its sketch; a document gives the shingles below the largest place of all
    sketches, the MinHash side of the search, which a short item can raise to nearly all of them. What meets an item's sketch is a candidate, and
    candidates are confirmed on the full shingle sets of both. Null or empty texts,
    null keys and items shorter than ``width`` words give nothing; rows that repeat a key
    count as one text each and are reported once.
    """
    sketch = stored(sketches(items, width, containment), "sketches")
    full = stored(
        shingled(items, "item_id", "text", width)
        .where(F.col("id").isNotNull())
        .select(F.col("id").alias("item_id"), F.explode("grams").alias("gram"))
        .distinct(),
        "items",
    )
    cut = sketch.agg(F.max("place").alias("most")).first()["most"]
    keyed = docs.select(F.col(key).alias(key), F.col("text").alias("text")).where(F.col(key).isNotNull())
    grams = shingled(keyed, key, "text", width)
    low = grams.select(
        F.col("id").alias(key),
        F.explode(F.array_distinct(F.filter("grams", lambda g: positive(g) <= F.lit(-1 if cut is None else cut)))).alias("gram"),
    )
    found = low.join(sketch.select("item_id", "gram"), "gram").select(key, "item_id").distinct()
    pairs = stored(found, "candidates")
    texts = keyed.join(pairs.select(key).distinct(), key, "left_semi")
    held = shingled(texts, key, "text", width).select(F.col("id").alias(key), F.explode(F.array_distinct("grams")).alias("gram"))
    matches = held.join(full, "gram").join(pairs, [key, "item_id"], "left_semi")
    shared = matches.groupBy(key, "item_id").agg(F.countDistinct("gram").alias("n_shared"))
    sizes = full.groupBy("item_id").agg(F.count("*").alias("n_item"))
    enough = F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(containment) - 1e-9)
    return shared.join(sizes, "item_id").where(enough).select(key, "item_id", "n_item", "n_shared")


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 5, containment: float = 0.8) -> DataFrame:
    """``docs`` without the documents that hold an item; rows with a null key stay."""
    hits = contaminated(docs, items, width, containment).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*[quoted(c) for c in docs.columns])
