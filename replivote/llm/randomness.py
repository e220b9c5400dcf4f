"""Secrets in texts: fixed patterns, and tokens that a battery of tests cannot tell from random ones."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import per_row, quoted, stored

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that have 16 characters
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets, the narrowest first; a token has the encoding of the first that holds it.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {name: frozenset(letters) for name, letters in ENCODINGS.items()}
#: p-values are counted on a grid of this many steps per power of ten, down to the last one.
STEPS, LAST = 20, 300

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns that are long enough, by start and kind."""
    spans = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def encoding(token: str) -> str | None:
    """The narrowest alphabet of a token with both letters and digits; none for plain words and numbers."""
    letters = set(token)
    if letters <= _SETS["base62"] - frozenset(_DIGITS) or not any(c.isalpha() for c in letters) or not any(c.isdigit() for c in letters):
        return None
    return next((name for name, allowed in _SETS.items() if letters <= allowed), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_tail(x: float, freedom: int) -> float:
    """Upper tail of chi-squared, by the cube-root approximation."""
    z = ((x / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity(values: np.ndarray, size: int) -> float:
    """Chi-squared test that all letters of the alphabet are as frequent, scaled to its spread in short tokens."""
    n = len(values)
    expected = n / size
    counts = np.bincount(values, minlength=size)
    total = float(((counts - expected) ** 2).sum()) / expected
    freedom = size - 1
    return _chi_tail(max(0.0, freedom + (total - freedom) / math.sqrt(1 - 1 / n)), freedom)


def runs(values: np.ndarray, size: int) -> float:
    """Runs test on the lower and upper half of the alphabet."""
    high = values >= size / 2
    n, up = len(values), int(high.sum())
    down = n - up
    if not up or not down:
        return 2.0 ** (1 - n)
    mean = 1 + 2 * up * down / n
    spread = (mean - 1) * (mean - 2) / (n - 1)
    seen = 1 + int((high[1:] != high[:-1]).sum())
    return _normal_tail((seen - mean) / math.sqrt(spread)) if spread > 0 else 1.0


def serial(values: np.ndarray) -> float:
    """Correlation of neighbouring letters' places in the alphabet."""
    x = values - values.mean()
    n, total = len(values), float((x * x).sum())
    if not total:
        return 0.0
    r = float((x[1:] * x[:-1]).sum()) / total
    return _normal_tail((r + 1 / n) * math.sqrt(n))


def randomness(token: str, name: str) -> float:
    """One p-value of the three tests (Fisher's sum of logarithms): small for text, even for random tokens."""
    place = {c: i for i, c in enumerate(ENCODINGS[name])}
    values = np.array([place[c] for c in token])
    tests = (uniformity(values, len(place)), runs(values, len(place)), serial(values))
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    return math.exp(-half) * (1 + half + half * half / 2)  # chi-squared tail with six degrees of freedom


def step_of(p: float) -> int:
    """Place of a p-value on the grid of logarithms."""
    return min(LAST * STEPS, int(-math.log10(max(p, 1e-320)) * STEPS))


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int, str, int]]:
    """Tokens that overlap no pattern: start, end, class of encoding and length, grid step of the p-value."""
    out, j, reach = [], 0, 0
    for m in _TOKEN.finditer(text):
        while j < len(spans) and spans[j][0] < m.end():
            reach = max(reach, spans[j][1])
            j += 1
        if m.start() < reach:
            continue
        name = encoding(m.group())
        if name:
            out.append((m.start(), m.end(), f"{name}:{len(m.group()).bit_length()}", step_of(randomness(m.group(), name))))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


_TESTED = T.StructType([T.StructField(n, T.StringType() if n == "stratum" else T.IntegerType()) for n in ("a", "b", "stratum", "step")])
FOUND = T.StructType([T.StructField("base", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("tokens", T.ArrayType(_TESTED))])


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with pattern spans ``base`` and tested ``tokens``."""

    def run(texts: list[str | None]) -> dict[str, list]:
        base = [base_spans(t or "") for t in texts]
        tokens = [[dict(zip(("a", "b", "stratum", "step"), c)) for c in candidates(t or "", b)] for t, b in zip(texts, base)]
        return {"base": [[list(s) for s in b] for b in base], "tokens": tokens}

    return per_row(docs, [text], FOUND, run, drop=(text,))


def cuts(found: DataFrame, rate: float = 0.01) -> DataFrame:
    """``stratum, cut``: grid step from which a stratum's tokens are ordinary text, not random.

    A stratum is an encoding and a power of two of the length, since short tokens give
    the tests little power and must not share a limit with long ones. Within it, the
    hypothesis of randomness is refused by the step-up rule over all its tokens, so that of
    those refused, at most ``rate`` are expected to be random. p-values are counted on
    their grid, so what is gathered is bounded by strata and steps.
    """
    from pyspark.sql import Window

    steps = found.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.step").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("stratum")
    below = whole.orderBy(F.desc("step"))
    counted = steps.withColumns({"rank": F.sum("n").over(below), "all": F.sum("n").over(whole)})
    p = F.pow(F.lit(10.0), -F.col("step") / F.lit(float(STEPS)))
    refused = counted.where(p <= F.col("rank") / F.col("all") * F.lit(rate))
    return refused.groupBy("stratum").agg(F.min("step").alias("cut"))


def secrets(docs: DataFrame, text: str = "text", rate: float = 0.01) -> DataFrame:
    """``docs`` without its text, with ``n_assign, n_access, n_hex`` (patterns only), ``base_sha256`` and ``spans``.

    Spans are the patterns' and, as ``random``, tokens of 20 and more characters that are
    not refused as random (see ``cuts``); they overlap no pattern. Null text counts as
    empty. Every row is returned, repeated ones too; input columns of these names are replaced, all others kept.
    """
    names = [f"n_{k}" for k in KINDS[:3]] + ["base_sha256", "spans"]
    kept = [quoted(c) for c in docs.columns if c.lower() not in (text.lower(), *names)]
    held = docs.select(F.struct(*kept).alias("row"), F.col(quoted(text)).alias("text"))  # no name of the input's meets one of ours
    found = stored(scanned(held), "tokens")
    limits = {r["stratum"]: r["cut"] for r in cuts(found, rate).collect()}  # encodings times lengths' powers of two
    fields = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, tokens in zip(batch.column("base").to_pylist(), batch.column("tokens").to_pylist()):
                spans = [tuple(s) for s in base]
                more = [(t["a"], t["b"], 3) for t in tokens if t["step"] < limits.get(t["stratum"], LAST * STEPS + 1)]
                counts = [sum(s[2] == k for s in spans) for k in range(3)]
                rows.append((*counts, sha256(listed(spans).encode()).hexdigest(), listed(spans + more)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["row", *names]
            )

    schema = T.StructType([found.schema["row"], *fields])
    return found.select("row", "base", "tokens").mapInArrow(run, schema).select("row.*", *names)
