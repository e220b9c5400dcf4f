"""Personal data in texts: fixed patterns, and a linear-chain CRF over word shapes that adds to them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import chunks, per_row, quoted

#: Kinds, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HOT = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|\s+|.", re.S)

Span = tuple[int, int, int]  # start, end, index in KINDS; code points, end exclusive


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def pattern_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """Every leftmost non-overlapping match per kind, and whether it passes its kind's test."""
    done = 0
    at = text.find("@")
    while at >= 0:  # an address starts with the run of letters that ends at its @: linear on long runs
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done, 0, True
        at = text.find("@", done)
    for m in _IP.finditer(text):
        yield m.start(), m.end(), 1, all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        yield m.start(), m.end(), 2, 14 <= len(digits) <= 19 and _luhn(digits)
    for m in _PHONE.finditer(text):
        yield m.start(), m.end(), 3, 10 <= len(_digits(m.group())) <= 15


def base_spans(text: str) -> list[Span]:
    return sorted(m[:3] for m in pattern_matches(text) if m[3])


def islands(text: str, margin: int = 12) -> list[tuple[int, int]]:
    """Parts of a text that hold a digit or an ``@``: whole blank-separated pieces and a margin around them."""
    found: list[tuple[int, int]] = []
    end = 0
    for m in _HOT.finditer(text):
        if m.start() < end:
            continue
        start, low = m.start(), end
        while start > low and not text[start - 1].isspace():
            start -= 1
        end = m.end()
        while end < len(text) and not text[end].isspace():
            end += 1
        left, right = max(0, start - margin), min(len(text), end + margin)
        if found and left <= found[-1][1]:
            found[-1] = (found[-1][0], right)
        else:
            found.append((left, right))
    return found


def shape(token: str) -> str:
    """Letters by case and rough length, digits by length, white space as one, other characters as they are."""
    if token[0].isdigit():
        return f"d{len(token)}" if len(token) < 5 else "d-8" if len(token) < 9 else "d-13" if len(token) < 14 else "d-19" if len(token) < 20 else "d+"
    if token[0].isalpha():
        case = "x" if token.islower() else "X" if token.isupper() else "Xx" if token[0].isupper() else "xX"
        return f"{case}{len(token) if len(token) < 3 else 4 if len(token) < 6 else 6}"
    if token.isspace():
        return "\n" if "\n" in token else " "
    return token if token.isascii() else "u"


LABELS = 1 + 2 * len(KINDS)  # outside; begin and inside per kind
FEATURES, WIDTH = 7, 1 << 14


def _slot(name: str) -> int:
    return crc32(name.encode("utf-8", "surrogatepass")) % WIDTH


def features(shapes: list[str], seen: dict[tuple, list[int]]) -> np.ndarray:
    """Per token the weight rows of its shape, two shapes to either side, and both neighbouring pairs.

    ``seen`` keeps the rows of a token's surroundings; surroundings recur in most tokens.
    """
    pad = ["^", "^", *shapes, "$", "$"]
    rows = []
    for i in range(len(shapes)):
        around = tuple(pad[i : i + 5])
        row = seen.get(around)
        if row is None:
            row = [_slot(f"{k}:{s}") for k, s in enumerate(around)]
            row += [_slot(f"l:{around[1]}|{around[2]}"), _slot(f"r:{around[2]}|{around[3]}")]
            seen[around] = row
        rows.append(row)
    return np.array(rows, dtype=np.int32).reshape(len(shapes), FEATURES)


@dataclass
class Crf:
    """Weights of shapes and of label changes."""

    weights: np.ndarray  # WIDTH x LABELS
    changes: np.ndarray  # LABELS x LABELS

    def decode(self, sequences: list[np.ndarray], cells: int = 1 << 20) -> list[np.ndarray]:
        """The best label path of every sequence by Viterbi, many sequences of similar length at a time."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int8)] * len(sequences)
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        start = 0
        while start < len(order):
            stop = start + 1
            while stop < len(order) and (stop + 1 - start) * len(sequences[order[stop]]) * LABELS <= cells:
                stop += 1
            group = order[start:stop]
            lengths = np.array([len(sequences[i]) for i in group])
            longest = int(lengths.max())
            scores = np.zeros((longest, len(group), LABELS))
            for g, i in enumerate(group):
                scores[: lengths[g], g] = self.weights[sequences[i]].sum(axis=1)
            back = np.zeros((longest, len(group), LABELS), dtype=np.int8)
            best = scores[0] + _START
            for t in range(1, longest):
                options = best[:, :, None] + self.changes[None]
                back[t] = options.argmax(axis=1)
                step = options.max(axis=1) + scores[t]
                best = np.where((t < lengths)[:, None], step, best)
            label = best.argmax(axis=1)
            paths = np.zeros((longest, len(group)), dtype=np.int8)
            for t in range(longest - 1, -1, -1):
                paths[t] = label
                label = np.where(t < lengths, back[t][np.arange(len(group)), label] if t else label, label)
            for g, i in enumerate(group):
                out[i] = paths[: lengths[g], g]
            start = stop
        return out


def _forbidden() -> np.ndarray:
    """An inside label follows only its own kind."""
    rules = np.zeros((LABELS, LABELS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        rules[:, inside] = -1e4
        rules[[inside - 1, inside], inside] = 0
    return rules


_RULES = _forbidden()
_START = np.array([0.0] + [0.0, -1e4] * len(KINDS))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def train(sequences: list[np.ndarray], labels: list[np.ndarray], rounds: int = 40, rate: float = 0.3, decay: float = 1e-3) -> Crf:
    """Maximum likelihood with a small penalty, by forward-backward over all sequences and Adam steps."""
    model = Crf(np.zeros((WIDTH, LABELS)), _RULES.copy())
    if not sequences:
        model.weights[:, 0] = 1.0
        return model
    order = np.argsort([len(s) for s in sequences], kind="stable")
    groups = [order[i : i + 512] for i in range(0, len(order), 512)]
    data = []
    for group in groups:
        lengths = np.array([len(sequences[i]) for i in group])
        longest = int(lengths.max())
        x = np.zeros((longest, len(group), FEATURES), dtype=np.int32)
        y = np.zeros((longest, len(group)), dtype=np.int64)
        for g, i in enumerate(group):
            x[: lengths[g], g], y[: lengths[g], g] = sequences[i], labels[i]
        data.append((x, y, np.arange(longest)[:, None] < lengths[None]))
    used = np.unique(np.concatenate([x[m].ravel() for x, _, m in data]))
    place = np.full(WIDTH, 0)
    place[used] = np.arange(len(used))
    data = [(place[x], y, m) for x, y, m in data]
    w, c = np.zeros((len(used), LABELS)), np.zeros((LABELS, LABELS))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(c), np.zeros_like(c)]
    total = len(sequences)
    for step in range(1, rounds + 1):
        gw, gc = decay * total * w, decay * total * c
        for x, y, mask in data:
            scores = w[x].sum(axis=2)
            scores[0] += _START
            steps, n = mask.shape
            moves = c + _RULES
            alpha, beta = np.zeros((steps, n, LABELS)), np.zeros((steps, n, LABELS))
            alpha[0] = scores[0]
            for t in range(1, steps):
                alpha[t] = np.where(mask[t][:, None], _sum_exp(alpha[t - 1][:, :, None] + moves, 1) + scores[t], alpha[t - 1])
            for t in range(steps - 2, -1, -1):
                back = _sum_exp(moves[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
                beta[t] = np.where(mask[t + 1][:, None], back, 0.0)
            norm = _sum_exp(alpha[-1], 1)
            post = np.exp(alpha + beta - norm[None, :, None]) * mask[:, :, None]
            hits = np.zeros((steps, n, LABELS))
            np.put_along_axis(hits, y[:, :, None], mask[:, :, None].astype(float), axis=2)
            error = (post - hits)[mask]
            rows = x[mask]
            for k in range(FEATURES):
                cells = (rows[:, k, None] * LABELS + np.arange(LABELS)).ravel()
                gw += np.bincount(cells, weights=error.ravel(), minlength=gw.size).reshape(gw.shape)
            for t in range(1, steps):
                live = mask[t]
                pair = alpha[t - 1][live][:, :, None] + moves + (scores[t] + beta[t])[live][:, None, :] - norm[live][:, None, None]
                gc += np.exp(pair).sum(axis=0)
                np.add.at(gc, (y[t - 1][live], y[t][live]), -1.0)
        for value, grad, i in ((w, gw / total, 0), (c, gc / total, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * grad
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * grad**2
            value -= rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-6)
    model.weights[used] = w
    model.weights[np.setdiff1d(np.arange(WIDTH), used)] = 0
    model.changes = c + _RULES
    return model


def _sequence(text: str, part: tuple[int, int], seen: dict[tuple, list[int]]) -> tuple[list[int], np.ndarray]:
    """Token starts (and the end) of a part of a text, and its features."""
    tokens = [(m.start(), m.group()) for m in _TOKEN.finditer(text, *part)]
    return [s for s, _ in tokens] + [part[1]], features([shape(t) for _, t in tokens], seen)


def labelled_parts(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 2000) -> DataFrame:
    """``text, spans``: a labelled table of at most ``sample`` short parts of texts.

    Parts are those of ``islands``, drawn in the order of a hash over all documents; their
    spans are what the fixed patterns accept. A part with a match that fails its test
    (a number of 16 digits with a wrong check digit) says nothing and is left out. Copies of a
    part count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "text"):
                rows = []
                for whole_text in batch.column("text").to_pylist():
                    for a, b in islands(whole_text or ""):
                        if b - a <= 200:
                            part = whole_text[a:b]
                            found = list(pattern_matches(part))
                            if all(ok or (k in (1, 2) and len(_digits(part[s:e])) < 12) for s, e, k, ok in found):
                                rows.append((part, [[s, e, k] for s, e, k, ok in sorted(found) if ok]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.list_(pa.int32())))], ["text", "spans"]
                )

    parts = docs.select(F.col(text).alias("text")).mapInArrow(run, "text string, spans array<array<int>>")
    once = parts.groupBy("text").agg(F.first("spans").alias("spans"))  # equal texts have equal spans
    return once.orderBy(F.xxhash64(F.lit(5), "text"), "text").limit(sample)


def fit(labelled: DataFrame, sample: int = 2000) -> Crf:
    """Train on the first ``sample`` rows of a labelled table ``text, spans``; spans are [start, end, kind] lists."""
    xs, ys, seen = [], [], {}
    for row in labelled.limit(sample).collect():
        starts, x = _sequence(row["text"], (0, len(row["text"])), seen)
        y = np.zeros(len(x), dtype=np.int64)
        for a, b, kind in row["spans"]:
            inside = [i for i in range(len(x)) if starts[i] < b and starts[i + 1] > a]
            y[inside] = 2 + 2 * kind
            y[inside[:1]] = 1 + 2 * kind
        xs.append(x)
        ys.append(y)
    return train(xs, ys)


def _plausible(kind: int, found: str) -> bool:
    """What no pattern asks but every datum of a kind has."""
    digits = len(_digits(found))
    return {0: "@" in found and "." in found, 1: found.count(".") >= 3 and digits >= 4, 2: digits >= 13, 3: digits >= 7}[kind]


def find(texts: list[str | None], model: Crf) -> list[tuple[list[Span], list[Span]]]:
    """Per text the spans of the patterns and those the model adds; an added span overlaps no other."""
    base = [base_spans(t or "") for t in texts]
    parts = [(i, part) for i, t in enumerate(texts) for part in islands(t or "")]
    seen: dict[tuple, list[int]] = {}
    made = [_sequence(texts[i], part, seen) for i, part in parts]
    added: list[list[Span]] = [[] for _ in texts]
    for (i, _), (starts, _x), path in zip(parts, made, model.decode([x for _, x in made])):
        t = 0
        while t < len(path):
            if path[t] and path[t] % 2:
                end = t + 1
                while end < len(path) and path[end] == path[t] + 1:
                    end += 1
                a, b, kind = starts[t], starts[end], (int(path[t]) - 1) // 2
                while a < b and texts[i][a].isspace():
                    a += 1
                while b > a and texts[i][b - 1].isspace():
                    b -= 1
                if _plausible(kind, texts[i][a:b]):
                    added[i].append((a, b, kind))
                t = end
            else:
                t += 1
    out = []
    for spans, more in zip(base, added):
        free = []
        j, reach = 0, 0
        for a, b, kind in sorted(more):
            while j < len(spans) and spans[j][0] < b:
                reach = max(reach, spans[j][1])
                j += 1
            if a >= reach:
                free.append((a, b, kind))
                reach = max(reach, b)
        out.append((spans, free))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def personal_data(docs: DataFrame, model: Crf, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``n_email, n_ip, n_card, n_phone`` (patterns only), ``base_sha256`` and ``spans``.

    Null text counts as empty: no spans, and the digest of an empty list. Every row is
    returned, repeated ones too; input columns of these names are replaced and those to
    ``drop`` left out.
    """

    def run(texts: list[str | None]) -> dict[str, list]:
        found = find(texts, model)
        out = {f"n_{k}": [sum(s[2] == i for s in base) for base, _ in found] for i, k in enumerate(KINDS)}
        out["base_sha256"] = [sha256(listed(base).encode()).hexdigest() for base, _ in found]
        out["spans"] = [listed(base + more) for base, more in found]
        return out

    fields = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return per_row(docs, [text], T.StructType(fields), run, drop)


def masked(docs: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """``docs`` with every datum in its text replaced by its kind in angle brackets; null stays null."""

    def one(value: str | None, spans: list[Span]) -> str | None:
        if value is None:
            return None
        out, at = [], 0
        for a, b, kind in sorted(spans):
            if a >= at:
                out += [value[at:a], f"<{KINDS[kind]}>"]
            at = max(at, b)
        return "".join([*out, value[at:]])

    def run(texts: list[str | None]) -> dict[str, list]:
        return {text: [one(t, base + more) for t, (base, more) in zip(texts, find(texts, model))]}

    done = per_row(docs, [text], T.StructType([T.StructField(text, T.StringType())]), run)
    return done.select(*[quoted(c) for c in docs.columns])
