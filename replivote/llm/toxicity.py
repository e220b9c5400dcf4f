"""Toxicity categories predicted one after another by a chain of linear models."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import chunks, per_row

#: Lengths of the beginnings of words that count as features.
STEMS = (4, 5, 6, 7)
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]{2,}")


def words_of(text: str | None) -> set[str]:
    """Words of letters in lower case, and runs of two and more signs."""
    return set(_TOKEN.findall((text or "").lower()))


def features_of(text: str | None) -> dict[str, int]:
    """Words, and the number of distinct words for each of their beginnings of four to seven letters."""
    found = words_of(text)
    out = dict.fromkeys(found, 1)
    for w in found:
        for k in STEMS:
            if len(w) > k:
                f = w[:k] + "*"
                out[f] = out.get(f, 0) + 1
    return out


def _value(count: int) -> float:
    return math.log2(1 + count)


@dataclass
class Chain:
    """For every category a vocabulary and weights: bias, number of words, features, earlier categories."""

    categories: list[str]
    vocabularies: list[dict[str, int]]
    weights: list[np.ndarray]

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """One row per text, one column per category; earlier columns feed the later models."""
        known = {}
        for c, vocabulary in enumerate(self.vocabularies):
            for f, i in vocabulary.items():
                known.setdefault(f, []).append((c, i))
        scores = np.tile(np.array([w[0] for w in self.weights]), (len(texts), 1))
        long = np.array([w[1] for w in self.weights])
        for row, text in enumerate(texts):
            hits: dict[str, int] = {}
            found = words_of(text)
            for w in found:
                if w in known:
                    hits[w] = 1
                for k in STEMS:
                    if len(w) > k and (f := w[:k] + "*") in known:
                        hits[f] = hits.get(f, 0) + 1
            scores[row] += long * _value(len(found))
            for f in sorted(hits):
                for c, i in known[f]:
                    scores[row, c] += self.weights[c][2 + i] * _value(hits[f])
        out = np.zeros_like(scores)
        for c, vocabulary in enumerate(self.vocabularies):
            earlier = self.weights[c][2 + len(vocabulary) :]
            out[:, c] = _logistic(scores[:, c] + (_logit(out[:, :c]) @ earlier if c else 0.0))
        return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 10) -> np.ndarray:
    """Logistic regression with a squared penalty on all but the bias, by Newton steps."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], penalty)
    ridge[0] = 1e-3
    for _ in range(rounds):
        p = _logistic(a @ w)
        slope = a.T @ (p - y) + ridge * w
        bend = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(ridge)
        w = w - np.linalg.solve(bend, slope)
    return w


def train_chain(
    labelled: DataFrame, categories: Sequence[str], key: str = "doc_id", sample: int = 8192, vocabulary: int = 200, folds: int = 5
) -> Chain:
    """A chain for ``labelled (key, text, one 0/1 column per category)``.

    It learns from the first ``sample`` rows in the order of a hash of the key; rows
    with a null label are left out. Each category's vocabulary is the ``vocabulary``
    features that tell its two classes apart best (chi-squared, in at least five
    rows). A later model sees earlier categories as out-of-fold predictions: each
    fifth of the rows is predicted by a model that has not seen it.
    """
    categories = list(categories)
    rows = labelled.select(key, "text", *categories).dropna(subset=categories)
    rows = rows.orderBy(F.xxhash64(F.lit(3), key), key).limit(sample).cache()
    try:
        kinds = [T.StructField("f", T.StringType())] + [T.StructField(c, T.LongType()) for c in categories]

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in chunks([whole], "text"):
                    found = [sorted(features_of(t)) for t in batch.column("text").to_pylist()]
                    counts = np.array([len(f) for f in found], dtype=np.int64)
                    labels = [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), counts)) for c in categories]
                    yield pa.RecordBatch.from_arrays([pa.array([f for fs in found for f in fs], pa.string()), *labels], ["f", *categories])

        total = rows.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
        seen = rows.select("text", *categories).mapInArrow(spread, T.StructType(kinds)).groupBy("f")
        counts = seen.agg(F.count("*").alias("n"), *[F.sum(F.col(c)).alias(c) for c in categories]).where("n >= 5").cache()
        vocabularies = []
        for c in categories:
            n, positive = total["n"], total[c] or 0
            expected = F.col("n") * F.lit(positive / max(n, 1))
            apart = (F.col(c) - expected) ** 2 / (expected * F.lit(1 - positive / max(n, 1)) * (1 - F.col("n") / F.lit(max(n, 1))) + 1e-9)
            best = counts.select("f", apart.alias("score")).orderBy(F.desc("score"), "f").limit(vocabulary).collect()
            vocabularies.append({r["f"]: i for i, r in enumerate(best)})
        counts.unpersist()
        known = [set(v) for v in vocabularies]

        def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = set().union(*known)
            for whole in batches:
                for batch in chunks([whole], "text"):
                    found, values, sizes = [], [], []
                    for t in batch.column("text").to_pylist():
                        counts = features_of(t)
                        found.append(sorted(wanted & counts.keys()))
                        values.append([_value(counts[f]) for f in found[-1]])
                        sizes.append(_value(len(words_of(t))))
                    some = batch.drop_columns(["text"]).append_column("f", pa.array(found, pa.list_(pa.string())))
                    yield some.append_column("v", pa.array(values, pa.list_(pa.float64()))).append_column("size", pa.array(sizes, pa.float64()))

        more = [T.StructField("f", T.ArrayType(T.StringType())), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("size", T.DoubleType())]
        schema = T.StructType([*rows.select(key, *categories).schema.fields, *more])
        small = rows.select(key, *categories, "text").mapInArrow(indexed, schema).orderBy(F.xxhash64(F.lit(3), key), key).collect()
    finally:
        rows.unpersist()
    fold = np.arange(len(small)) % folds
    weights, earlier = [], np.zeros((len(small), 0))
    for c, vocab in zip(categories, vocabularies):
        x = np.zeros((len(small), 1 + len(vocab)))
        for i, row in enumerate(small):
            x[i, 0] = row["size"]
            for f, v in zip(row["f"], row["v"]):
                if f in vocab:
                    x[i, 1 + vocab[f]] = v
        x = np.hstack([x, _logit(earlier)])
        y = np.array([row[c] for row in small], dtype=float)
        outside = np.zeros(len(small))
        for k in range(folds if len(small) else 0):
            w = _fit(x[fold != k], y[fold != k])
            outside[fold == k] = _logistic(np.hstack([np.ones((int((fold == k).sum()), 1)), x[fold == k]]) @ w)
        weights.append(_fit(x, y) if len(small) else np.zeros(1 + x.shape[1]))
        earlier = np.hstack([earlier, outside[:, None]])
    return Chain(categories, vocabularies, weights)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = 8192) -> DataFrame:
    """``docs (key, text)`` with their ``labels``, for at most ``sample`` labelled keys drawn by a hash.

    The drawn labels are few by that bound, so they go to the texts and no text is moved.
    """
    drawn = labels.dropna(subset=[key]).orderBy(F.xxhash64(F.lit(3), key), key).limit(sample)
    return docs.select(key, "text").join(F.broadcast(drawn), key)


def judged(docs: DataFrame, chain: Chain, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``p_<category>`` per category; a null or empty text has probability 0 of each.

    Every row is returned where it lies; input columns of these names are replaced and
    those to ``drop`` left out.
    """
    names = [f"p_{c}" for c in chain.categories]

    def run(texts: list[str | None]) -> dict[str, list]:
        found = chain.probabilities(texts)
        found[[not (t or "").strip() for t in texts]] = 0.0
        return {n: found[:, i].tolist() for i, n in enumerate(names)}

    return per_row(docs, [text], T.StructType([T.StructField(n, T.DoubleType()) for n in names]), run, drop)
