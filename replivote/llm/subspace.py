"""Near-duplicate vectors: blocks of rotated coordinates are range-joined in chunks, and pairs confirmed exactly.

Two unit vectors of cosine ``c`` lie ``2 - 2c`` apart (squared). If that total is dealt
to blocks of coordinates in proportion to their size, a close pair keeps the budget
of one block at least, so the union over blocks of pairs within budget misses none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import stored
from replivote.llm.components import components

#: Coordinates of a block, vectors and bytes (as doubles) of a chunk at most, and rows of one product. Wider blocks than that
#: refuse little more by one coordinate, narrower ones leave more products and more copies of the vectors.
BLOCK, CHUNK, CHUNK_BYTES, TILE = 64, 4096, 2 << 20, 1024
HELD_BYTES = 16 << 20  # of vectors that a task holds until it cuts them into chunks


def rotation(size: int) -> np.ndarray:
    """A fixed random rotation, so that no block depends on how the coordinates were laid out."""
    q, r = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def blocks(size: int) -> list[slice]:
    """Coordinates in blocks of about ``BLOCK``."""
    edges = np.linspace(0, size, max(1, size // BLOCK) + 1).astype(int)
    return [slice(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


def budgets(size: int, cosine: float) -> np.ndarray:
    """Squared distance that each block may take; a little is added for rounding."""
    return np.array([(b.stop - b.start) / size for b in blocks(size)]) * (2 - 2 * cosine) + 1e-9


def _vectors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and their rotations."""
    unit = raw.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)  # against overflow
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return unit, unit @ rotation(raw.shape[1])


def placed(classes: DataFrame, cosine: float, kind: str) -> DataFrame:
    """Chunks of vectors, a row each: ``size, block, chunk, low, high, reach, reps, ns, vecs``.

    The vectors of a partition lie in order of the first coordinate of the block, from ``low`` to ``high``;
    vectors further than ``reach`` from both meet none within budget. ``kind`` is the number type of ``vec``.
    """

    def cut(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = held["vec"].shape[1]
        _, turned = _vectors(held["vec"])
        most = max(1, min(CHUNK, CHUNK_BYTES // (8 * size)))
        for b, (part, budget) in enumerate(zip(blocks(size), budgets(size, cosine))):
            first = turned[:, part.start]
            order = np.argsort(first, kind="stable")
            for at in range(0, len(order), most):
                some = order[at : at + most]
                reps, ns = held["rep"][some], held["n"][some]
                ends = [float(first[some[0]]), float(first[some[-1]]), float(np.sqrt(budget) * (1 + 1e-6))]
                row = [size, b, int(reps.min()), *ends, reps.tobytes(), ns.tobytes(), held["vec"][some].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

    names = ["size", "block", "chunk", "low", "high", "reach", "reps", "ns", "vecs"]
    types = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * 3, *[pa.binary()] * 3]
    ddl = "size int, block int, chunk long, low double, high double, reach double, reps binary, ns binary, vecs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, list[dict[str, np.ndarray]]] = {}
        held: Counter[int] = Counter()
        joined = lambda size: {k: np.concatenate([p[k] for p in pieces[size]]) for k in ("rep", "n", "vec")}
        for batch in batches:
            vecs = batch.column("vec")
            sizes = pc.binary_length(vecs).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
            for size in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == size))
                raw = np.frombuffer(b"".join(some.column("vec").to_pylist()), kind).reshape(-1, size)
                own = {"rep": some.column("rep").to_numpy(), "n": some.column("n").to_numpy(), "vec": raw}
                pieces.setdefault(size, []).append(own)
                held[size] += raw.nbytes
                if held[size] >= HELD_BYTES:
                    yield from cut(joined(size))
                    del pieces[size], held[size]
        for size in pieces:
            yield from cut(joined(size))

    return classes.select("rep", "n", "vec").mapInArrow(run, ddl)


def _root(labels: np.ndarray) -> np.ndarray:
    while True:
        up = labels[labels]
        if (up == labels).all():
            return labels
        labels = up


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each node's smallest known companion) after more links."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        labels = _root(labels)


class _Chunk:
    """Vectors of a chunk, with what a product of one block needs of them."""

    def __init__(self, size: int, block: int, reps: bytes, ns: bytes, vecs: bytes, kind: str):
        self.reps, self.n = np.frombuffer(reps, np.int64), np.frombuffer(ns, np.int64)
        self.unit, self.turned = _vectors(np.frombuffer(vecs, kind).reshape(-1, size))
        own = self.turned[:, blocks(size)[block]]
        length = (own * own).sum(axis=1, keepdims=True)
        one = np.ones_like(length)
        self.ahead, self.behind = (np.hstack(v).astype(np.float32) for v in ((-2 * own, length, one), (own, one, length)))


def compare(left: _Chunk, right: _Chunk, block: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two chunks, or within one: nodes with links, how many vectors each is linked to, and a companion of each.

    A pair is counted in the first block in whose budget it lies, and nowhere else, so that
    sums over tasks count every pair once.
    """
    alone = left is right
    size = left.unit.shape[1]
    parts, budget = blocks(size), budgets(size, cosine)
    # squared distances as one product in single precision, which refuses; what is left is looked at in double
    limit = np.float32(budget[block] + 1e-5)
    shift = 0 if alone else len(left.reps)
    links = np.zeros(shift + len(right.reps), dtype=np.int64)
    labels = np.arange(len(links))
    for i in range(0, len(left.reps), TILE):
        for j in range(i if alone else 0, len(right.reps), TILE):
            ahead, behind = left.ahead[i : i + TILE], right.behind[j : j + TILE]
            near = np.flatnonzero(ahead @ behind.T <= limit)
            a, b = near // len(behind) + i, near % len(behind) + j
            if alone and i == j:
                a, b = a[a < b], b[a < b]
            for k in range(0, len(a), 1 << 17):
                p, q = a[k : k + (1 << 17)], b[k : k + (1 << 17)]
                square = (left.turned[p] - right.turned[q]) ** 2
                within = np.stack([square[:, s].sum(axis=1) <= budget[m] for m, s in enumerate(parts[: block + 1])])
                first = within[block] & ~within[:block].any(axis=0)
                p, q = p[first], q[first]
                close = np.einsum("ij,ij->i", left.unit[p], right.unit[q]) >= cosine
                p, q = p[close], q[close]
                links += np.bincount(p, weights=right.n[q], minlength=len(links)).astype(np.int64)
                links += np.bincount(q + shift, weights=left.n[p], minlength=len(links)).astype(np.int64)
                labels = _joined(labels, p, q + shift)
    some = np.flatnonzero(links)
    reps = left.reps if alone else np.concatenate([left.reps, right.reps])
    return reps[some], links[some], reps[labels[some]]


def linked_classes(classes: DataFrame, cosine: float, kind: str = "<f8") -> DataFrame:
    """``rep, links, other`` per pair of chunks and class: links counted once over all pairs, and one companion.

    Chunks are stored once and meet by a range join without a shuffle: each task reads its two shares of them from the
    shared folder, so what lies on disk is the vectors, not the vectors times the chunks they meet.
    """
    chunks = stored(placed(classes, cosine, kind), "chunks")
    left, right = (chunks.select(*[F.col(c).alias(f"{side}_{c}") for c in chunks.columns]) for side in ("l", "r"))
    # differences, not equalities: those would deal all chunks of one block to one task
    apart = "l_size - r_size = 0 and l_block - r_block = 0 and l_chunk <= r_chunk and l_low - r_high <= l_reach and r_low - l_high <= l_reach"
    pairs = left.join(right, F.expr(apart))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("l_size", "l_block", "l_chunk", "r_chunk")]
            for at, (size, block, one, two) in enumerate(zip(*[c.to_pylist() for c in columns])):
                chunk = lambda side: _Chunk(size, block, *[batch.column(f"{side}_{c}")[at].as_py() for c in ("reps", "ns", "vecs")], kind)  # noqa: E731, B023
                if known != (size, block, one):
                    known, held = (size, block, one), chunk("l")
                reps, links, other = compare(held, held if one == two else chunk("r"), block, cosine)
                yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(links), pa.array(other)], ["rep", "links", "other"])

    columns = [*[f"l_{c}" for c in ("size", "block", "chunk", "reps", "ns", "vecs")], *[f"r_{c}" for c in ("chunk", "reps", "ns", "vecs")]]
    return pairs.select(*columns).mapInArrow(run, "rep long, links long, other long")


def near_vectors(vectors: DataFrame, cosine: float = 0.9, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link if the cosine of their vectors, in double precision, is at least ``cosine``
    and their sizes are equal. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null key, link with nothing. Equal vectors
    are compared once, as a class, and count as often as they occur. Keys are taken to
    be unique; other columns are not looked at.
    """
    vec = F.col(column).cast("array<double>")
    single = vectors.schema[column].dataType == T.ArrayType(T.FloatType(), vectors.schema[column].dataType.containsNull)
    kind = "<f4" if single else "<f8"  # what is stored of a vector are its numbers as they came, or doubles
    sound = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x)) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.when(sound & F.col(key).isNotNull(), vec).alias("v"), F.col(column).alias("raw") if single else vec.alias("raw"))
    rows = rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(9), "v")})
    valid = rows.where("v is not null")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = [np.array(v, dtype=kind).tobytes() for v in batch.column("raw").to_pylist()]
            yield batch.drop_columns(["raw"]).append_column("vec", pa.array(vecs, pa.binary()))

    grouped = valid.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("raw").alias("raw"))
    classes = stored(grouped.mapInArrow(packed, "k1 long, k2 long, rep long, n long, vec binary"), "vectors")
    found = stored(linked_classes(classes, cosine, kind), "links")
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    near = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    known = (
        classes.select("k1", "k2", "rep", "n")
        .join(sums, "rep", "left")
        .join(near.withColumnRenamed("node", "rep"), "rep", "left")
        .select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    links = valid.select("id", "k1", "k2").join(known, ["k1", "k2"])
    apart = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    every = links.select("id", "n_links", "component").unionByName(apart)
    return every.select(
        F.col("id").alias(key),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
