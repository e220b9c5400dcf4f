"""Near-duplicate documents by HyperMinHash sketches.

A sketch has one register per bucket of a text's shingles: the smallest hash of the
bucket, kept as its number of leading zeros and a few bits after them. Equal bands of
registers propose pairs, an estimate of the similarity from all registers refuses most
false ones, and the full shingle sets decide.

Texts of one shingle set are one class; only classes are compared. A bucket of classes
that share a band is not expanded into pairs: all members meet one leader, links are
closed into components, and only buckets whose members are still apart are compared
further, the members outside the largest component with all others, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import chunks, quoted, stored
from replivote.llm.components import components
from replivote.llm.shingles import mixed, shingle_sets

#: Registers of a sketch, registers of a band, and bits after the leading zeros.
REGISTERS, ROWS, MANTISSA = 160, 5, 10
BANDS = REGISTERS // ROWS
#: Classes of one block in the comparison of buckets that stay apart.
BLOCK = 512
#: Two different minima agree in a register with at most about this chance: equal
#: leading zeros (1/3) and equal mantissa bits.
CHANCE = 2.0**-MANTISSA / 3


def registers(gram: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of ``REGISTERS`` 16-bit registers per set of shingle hashes.

    Every shingle falls into one bucket. A bucket that none falls into takes the register
    of another bucket of the same set, found by a fixed sequence of guesses, so that
    registers of two sets agree with the chance of their similarity however small they are.
    """
    n = len(ends)
    owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    with np.errstate(over="ignore"):
        stirred = mixed(gram + np.uint64(0x632BE59BD9B4E019))
    bucket = (stirred >> np.uint64(40)) % np.uint64(REGISTERS)
    value = stirred & np.uint64((1 << 40) - 1)
    lowest = np.full(n * REGISTERS, np.uint64(1 << 40), dtype=np.uint64)
    np.minimum.at(lowest, owner * REGISTERS + bucket.astype(np.int64), value)
    filled = (lowest < (1 << 40)).reshape(n, REGISTERS)
    exponent = np.frexp(lowest.astype(np.float64))[1]  # bits of the value; 40 minus it are leading zeros
    zeros = np.minimum(40 - exponent, 62).clip(0)
    after = np.where(exponent > MANTISSA + 1, lowest >> (exponent - 1 - MANTISSA).clip(0).astype(np.uint64), lowest)
    packed = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA)) | (after & np.uint64((1 << MANTISSA) - 1))
    out = np.where(filled, packed.reshape(n, REGISTERS), 0).astype(np.uint16)
    some = filled.any(axis=1)
    here = filled.copy()
    guess = 0
    while some.any() and not here[some].all():
        guess += 1
        with np.errstate(over="ignore"):
            source = mixed(np.arange(REGISTERS, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(guess)) % np.uint64(REGISTERS)
        source = source.astype(np.int64)
        take = ~here & filled[:, source]
        out = np.where(take, out[:, source], out)
        here |= take
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from two arrays of registers, less the agreements that chance alone gives."""
    agree = (a == b).mean(axis=-1)
    return (agree - CHANCE) / (1 - CHANCE)


def refused(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose estimate lies six standard errors below the threshold."""
    return estimate(a, b) < threshold - 6 * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def sketched(docs: DataFrame, key: str, width: int) -> DataFrame:
    """``id, n, lo, hi, regs``: size, 128-bit digest of the shingle set, and sketch of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "text"):
                gram, ends = shingle_sets(batch.column("text").to_pylist(), width)
                counts = np.diff(ends, prepend=0)
                sums = lambda x: np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])[ends], prepend=np.uint64(0))
                with np.errstate(over="ignore"):
                    lo, hi = sums(mixed(gram)), sums(mixed(gram ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
                regs = registers(gram, ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(counts, pa.int64()), pa.array(lo.view(np.int64)), pa.array(hi.view(np.int64)),
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    ["id", "n", "lo", "hi", "regs"],
                )

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col("text").alias("text"))
    return narrow.mapInArrow(run, "id long, n long, lo long, hi long, regs binary")


def sets_of(docs: DataFrame, key: str, width: int) -> DataFrame:
    """``id, gram``: the sorted shingle hashes of every text as one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "text"):
                gram, ends = shingle_sets(batch.column("text").to_pylist(), width)
                cut = np.split(gram, ends[:-1]) if len(ends) else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([c.tobytes() for c in cut], pa.binary())], ["id", "gram"]
                )

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col("text").alias("text"))
    return narrow.mapInArrow(run, "id long, gram binary")


def banded(sketch: DataFrame) -> DataFrame:
    """``band, id``: a 64-bit key per band of each sketch."""
    size = 2 * ROWS
    keys = [F.xxhash64(F.lit(i), F.substring("regs", 1 + i * size, size)) for i in range(BANDS)]
    return sketch.select("id", F.explode(F.array(*keys)).alias("band"))


def linked(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def estimated(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """``a, b, score`` of the pairs that the estimate does not refuse."""
    side = lambda n: sketch.select(F.col("id").alias(n), F.col("regs").alias(f"r{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            if batch.num_rows:
                x, y = get("ra"), get("rb")
                keep = ~refused(x, y, threshold)
                kept = batch.select(["a", "b"]).filter(pa.array(keep))
                yield kept.append_column("score", pa.array(estimate(x[keep], y[keep]), pa.float64()))

    return both.select("a", "b", "ra", "rb").mapInArrow(run, "a long, b long, score double")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    side = lambda n: sets.select(F.col("id").alias(n), F.col("gram").alias(f"g{n}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x.as_py(), y.as_py(), percent) for x, y in zip(batch.column("ga"), batch.column("gb"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def labelled(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, label``: the component of every id, itself where no edge touches it."""
    found = components(edges)
    return ids.join(found.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("label"))


def _crossing(batches: Iterator[pa.RecordBatch], percent: int) -> tuple[list[int], list[int]]:
    """Links that join different labels, between the left rows of a block and all its rows."""
    rows = pa.Table.from_batches(list(batches))
    ids, left = rows.column("id").to_numpy(), rows.column("left").to_numpy(zero_copy_only=False).astype(bool)
    label = {i: int(v) for i, v in enumerate(rows.column("label").to_pylist())}
    regs = np.frombuffer(b"".join(rows.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    grams = rows.column("gram").to_pylist()
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while top.get(x, x) != x:
            top[x] = top.get(top[x], top[x])
            x = top[x]
        return x

    a, b = [], []
    for i in np.flatnonzero(left):
        score = estimate(regs, regs[i])
        others = np.flatnonzero(~refused(regs, regs[i], percent / 100))
        for j in others[np.argsort(-score[others], kind="stable")]:
            x, y = root(label[i]), root(label[j])
            if x != y and linked(grams[i], grams[j], percent):
                top[max(x, y)] = min(x, y)
                a.append(int(ids[i]))
                b.append(int(ids[j]))
    return a, b


def crossings(bands: DataFrame, labels: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links between components that share a bucket, enough of them to close every component.

    Of each bucket with several components, the members outside the largest are the
    satellites of that largest one, its hub. A hub's satellites are compared with its
    members and with one another in blocks; nothing is skipped but pairs already joined.
    """
    members = bands.join(labels, "id")
    sizes = members.groupBy("band", "label").agg(F.count("*").alias("n"))
    hubs = sizes.groupBy("band").agg(
        F.max_by("label", F.struct("n", -F.col("label"))).alias("hub"), F.count("*").alias("labels"), F.sum("n").alias("n")
    )
    apart = hubs.where("labels > 1 and n > 2").select("band", "hub")
    outside = stored(members.join(apart, "band").where("label != hub").select("hub", "id", "label").distinct(), "satellites")
    inside = labels.join(outside.select(F.col("hub").alias("label")).distinct(), "label", "left_semi")
    rows = outside.withColumn("left", F.lit(True)).unionByName(
        inside.select(F.col("label").alias("hub"), "id", "label").withColumn("left", F.lit(False))
    )
    counts = rows.groupBy("hub").agg(
        F.ceil(F.sum(F.col("left").cast("int")) / BLOCK).cast("int").alias("lefts"), F.ceil(F.count("*") / BLOCK).cast("int").alias("all")
    )
    dealt = rows.join(counts, "hub").withColumns(
        {"x": F.pmod(F.xxhash64("id"), F.col("lefts")).cast("int"), "y": F.pmod(F.xxhash64("id", F.lit(1)), F.col("all")).cast("int")}
    )
    seen = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: F.struct(i.alias("x"), F.col("y").alias("y"), F.lit(False).alias("left")))
    own = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda i: F.struct(F.col("x").alias("x"), i.alias("y"), F.lit(True).alias("left")))
    places = F.concat(seen, F.when(F.col("left"), own).otherwise(F.array().cast("array<struct<x:int,y:int,left:boolean>>")))
    placed = dealt.select("hub", "id", "label", F.explode(places).alias("p")).select("hub", "id", "label", "p.*")
    merged = placed.groupBy("hub", "x", "y", "id").agg(F.max("left").alias("left"), F.first("label").alias("label"))
    full = merged.join(sketch.select("id", "regs"), "id").join(sets, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _crossing(batches, percent)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return full.groupBy("hub", "x", "y").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 2, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row of ``docs (key, text)``.

    Rows link if 100 times their common shingles are at least ``percent`` times their
    union; components close the links. Null texts, texts without words and rows with a
    null key link with nothing (a null key keeps a null component and stays). Rows that
    repeat a key or a text are all returned. Other columns are not looked at.

    The chance that the bands miss one linked pair of similarity 0.8 is 3e-6
    (``(1 - 0.8**5)**32``), and less above; a link between different sets counts only
    after the check on full sets.
    """
    threshold = percent / 100
    sketch = stored(sketched(docs, key, width), "sketches")
    nonempty = sketch.where("id is not null and n > 0")
    classes = stored(nonempty.groupBy("lo", "hi", "n").agg(F.min("id").alias("rep"), F.min_by("regs", "id").alias("regs")), "classes")
    reps = classes.select(F.col("rep").alias("id"), "regs")
    bands = banded(reps)
    sizes = bands.groupBy("band").agg(F.min_by("id", F.xxhash64("id", "band")).alias("leader"), F.count("*").alias("n"))
    shared = stored(bands.join(sizes.where("n > 1"), "band"), "buckets")
    stars = shared.where("id != leader").select(F.greatest("id", "leader").alias("a"), F.least("id", "leader").alias("b"), "n")
    star = stars.groupBy("a", "b").agg(F.max("n").alias("n"))
    pairs = stored(estimated(star.select("a", "b"), reps, threshold), "pairs")
    needed = pairs.select("a").union(pairs.select("b")).union(shared.where("n > 2").select("id")).distinct()
    texts = docs.select(F.col(key).cast("long").alias("id"), "text").join(needed.withColumnRenamed("a", "id"), "id")
    sets = stored(sets_of(texts, "id", width), "sets")
    ids = reps.select("id")
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("score", "b")).alias("b"))
    edges = stored(verified(best, sets, percent), "links")
    labels = stored(labelled(ids, edges), "labels")
    rest = _apart(pairs.join(best, ["a", "b"], "left_anti"), labels)
    edges = stored(edges.union(verified(rest, sets, percent)), "links")
    labels = stored(labelled(ids, edges), "labels")
    edges = edges.union(crossings(shared.select("band", "id"), labels, reps, sets, percent))
    labels = stored(labelled(ids, edges), "labels")
    found = classes.select("lo", "hi", "n", F.col("rep").alias("id")).join(labels, "id").select("lo", "hi", "n", "label")
    # classes of thousands of copies meet one row each; the adaptive planner splits them
    joined = sketch.select("id", "n", "lo", "hi").join(found, ["lo", "hi", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("label", "id"))
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends have different labels."""
    side = lambda n: labels.select(F.col("id").alias(n), F.col("label").alias(f"l{n}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where("la != lb").select("a", "b")


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest key.

    Rows that repeat a kept key all stay, as do rows without words or with a null key.
    """
    found = near_duplicates(docs, width, percent, key)
    drop = found.where("not kept").select(key).distinct()
    return docs.join(drop, key, "left_anti").select(*[quoted(c) for c in docs.columns])
