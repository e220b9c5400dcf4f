"""Vector codes: parts of a vector as indexes into trained codebooks, searched in whole numbers only."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import _arrow, quoted, stored

#: Whole-number components from here on could make squared distances that a long does not hold.
LIMIT = 2.0**26
_ROWS = 8192  # vectors searched at a time


def sequency_order(width: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``width`` (a power of two) by their number of sign changes."""
    signs = walsh_hadamard(np.eye(width, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """The transform of every row, in whole numbers; the width is a power of two."""
    out, half = rows.copy(), 1
    while half < rows.shape[1]:
        pairs = out.reshape(len(out), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), -1)
        half *= 2
    return out


def _exact(width: int, top: int) -> type:
    """Machine words where no sum of squares can overflow them, else Python's whole numbers."""
    return np.int64 if 4 * top * top * width * width * width < 2**62 else object


def spectrum(rows: np.ndarray, width: int) -> np.ndarray:
    """Transforms of rows padded with zeros to ``width``, in order of sequency."""
    padded = np.zeros((len(rows), width), dtype=rows.dtype)
    padded[:, : rows.shape[1]] = rows
    return walsh_hadamard(padded)[:, sequency_order(width)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part (ties: the lower) and its squared distance.

    The transform multiplies squared distances by the padded width. They grow
    coefficient by coefficient, low sequency first; an entry leaves as soon as its sum
    exceeds the full distance of the entry that is nearest by the first coefficient.
    """
    if not parts.shape[1]:
        return np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
    width = 1 << (parts.shape[1] - 1).bit_length()
    top = max((int(np.abs(x).max()) for x in (parts, entries) if x.size), default=0)
    kind = _exact(width, top)
    own, known = spectrum(parts.astype(kind), width), spectrum(entries.astype(kind), width)
    if not len(own):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = (own[:, :1] - known[:, 0]) ** 2
    guess = known[first.argmin(axis=1)]
    bound = ((own - guess) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= bound[:, None])  # never empty: the guess itself stays
    total = first[row, entry]
    for k in range(1, width):
        total = total + (own[row, k] - known[entry, k]) ** 2
        stays = np.flatnonzero(total <= bound[row])
        row, entry, total = row[stays], entry[stays], total[stays]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(total, starts)
    hits = np.flatnonzero(total == np.repeat(least, np.diff(np.r_[starts, len(row)])))
    best = hits[np.r_[True, row[hits][1:] != row[hits][:-1]]]
    return entry[best], least // width


def _lists(column: pa.Array) -> np.ndarray:
    """A column of equally long lists without nulls as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def whole_numbers(vectors: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """Rows whose vector is present and finite, with ``_x``: ``floor(scale * x)`` of each component."""
    x = F.col(quoted(vector)).cast("array<double>")
    sound = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    checked = F.transform(
        x, lambda v: F.when(F.abs(v * scale) < LIMIT, F.floor(v * scale)).otherwise(F.raise_error(F.lit("a component is too large for codes")).cast("long"))
    )
    return vectors.where(F.coalesce(sound, F.lit(False))).withColumn("_x", checked)


def first_vectors(numbers: DataFrame, key: str, count: int) -> np.ndarray:
    """The ``count`` vectors of smallest key, ascending, ties by their components. Ids are compared first."""
    known = numbers.where(F.col(key).isNotNull())
    last = known.select(key).orderBy(key).limit(count).agg(F.max(key)).first()[0]
    if last is None:
        return np.zeros((0, 0), dtype=np.int64)
    rows = known.where(F.col(key) <= F.lit(last)).groupBy(key, "_x").count().orderBy(key, "_x").limit(count).collect()
    return np.array([r["_x"] for r in rows for _ in range(r["count"])][:count], dtype=np.int64)


def _searched(df: DataFrame, keep: list[str], books: np.ndarray, parts: int, run, schema: T.StructType) -> DataFrame:
    """``run(batch, entry indexes, distances, numbers)`` over batches of whole-number vectors."""
    width = books.shape[1] // parts

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x = _lists(batch.column(batch.num_columns - 1)).astype(np.int64)
                found = [nearest(x[:, p * width : (p + 1) * width], books[:, p * width : (p + 1) * width]) for p in range(parts)]
                yield run(batch, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1), x)

    return df.select(*keep, "_x").mapInArrow(batches, schema)


def _sums(df: DataFrame, books: np.ndarray, parts: int) -> list[np.ndarray]:
    """Per part and entry: how many parts are nearest to it, and their sums by component."""
    entries, dims = books.shape
    width = dims // parts
    kind = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType())])
    kind = kind.add("n", T.LongType()).add("sums", T.ArrayType(T.LongType()))

    def run(batch, found, _distance, x):
        rows = [[], [], [], []]
        for p in range(parts):
            used, where, n = np.unique(found[:, p], return_inverse=True, return_counts=True)
            sums = np.zeros((len(used), width), dtype=np.int64)
            np.add.at(sums, where, x[:, p * width : (p + 1) * width])
            for column, values in zip(rows, ([p] * len(used), used.tolist(), n.tolist(), sums.tolist())):
                column.extend(values)
        return pa.RecordBatch.from_arrays([pa.array(v, _arrow(f.dataType)) for v, f in zip(rows, kind.fields)], kind.names)

    each = _searched(df, [], books, parts, run, kind)
    sums = [F.sum(F.col("sums")[i]) for i in range(width)]
    return each.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*sums).alias("sums")).collect()


def trained(numbers: DataFrame, key: str = "vec_id", parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks side by side, an entry per row: the first vectors, moved ``rounds`` times to their parts' means.

    Means are rounded down. Entries that no part is nearest to stay. A round is one
    scan; each task sums what it has read, and sums of at most ``parts * entries`` rows
    come to the driver.
    """
    books = first_vectors(numbers, key, entries)
    if not books.size:
        return books
    width = books.shape[1] // parts
    same = numbers.where(F.size("_x") == books.shape[1])
    for _ in range(rounds):
        new = books.copy()
        for r in _sums(same, books, parts):
            new[r["entry"], r["part"] * width : (r["part"] + 1) * width] = [s // r["n"] for s in r["sums"]]
        books = new
    return books


def books_sha256(books: np.ndarray, parts: int) -> str:
    """Digest of all components by part, entry and place."""
    width = books.shape[1] // parts if books.size else 0
    numbers = [str(v) for p in range(parts) for row in books[:, p * width : (p + 1) * width].tolist() for v in row]
    return sha256(",".join(numbers).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
) -> DataFrame:
    """``key, label, codes, error, label_error, codebooks_sha256`` of every vector that has a code.

    ``codes`` are the entry indexes by part, ``error`` the squared distances summed over the
    parts, ``label_error`` the errors summed over the rows of an equal label, null being one.
    Vectors that are null or hold null or non-finite components are left out, and
    so are those of another length than the vector of the smallest key, whose length must be a
    multiple of ``parts``. Rows with a null key are coded but start no entry; rows that
    repeat a key are rows of their own, taken by their components. With fewer rows than
    ``entries`` the codebooks are shorter; an empty table gives an empty result. Other columns
    do not travel. Components of ``2**26 / scale`` or more are refused with an error.
    """
    named = vectors.select(F.col(quoted(key)).alias("_key"), F.col(quoted(label)).alias("_label"), F.col(quoted(vector)).alias("_v"))
    numbers = whole_numbers(named, "_v", scale).select("_key", "_label", "_x")
    books = trained(numbers, "_key", parts, entries, rounds)
    if books.shape[1] % parts:
        raise ValueError(f"vectors of {books.shape[1]} components cannot be cut into {parts} equal parts")
    kind = T.StructType([f for f in numbers.schema.fields if f.name != "_x"])
    kind = kind.add("codes", T.ArrayType(T.IntegerType())).add("error", T.LongType())

    def run(batch, found, distance, _x):
        codes = pa.ListArray.from_arrays(
            pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32()), pa.array(found.ravel(), pa.int32())
        )
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, pa.array(distance.sum(axis=1), pa.int64())], kind.names)

    if books.size:
        coded = _searched(numbers.where(F.size("_x") == books.shape[1]), ["_key", "_label"], books, parts, run, kind)
    else:
        coded = vectors.sparkSession.createDataFrame([], kind)
    coded = stored(coded, "codes")
    per_label = coded.groupBy(F.col("_label").alias("_l")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(per_label, F.col("_label").eqNullSafe(F.col("_l")))
    return joined.select(
        F.col("_key").alias(key), F.col("_label").alias(label), "codes", "error", "label_error", F.lit(books_sha256(books, parts)).alias("codebooks_sha256")
    )


def hex_code(codes: str = "codes") -> F.Column:
    """Indexes as two hex digits each."""
    return F.array_join(F.transform(codes, lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "")
