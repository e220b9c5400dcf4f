"""Repeated passages across documents: suffix arrays and interval expansion over shared neighbourhoods.

Every string of ``least`` bytes is owned by one of its ``GRAM``-byte grams, the one that a
fixed order puts first (its anchor), so equal strings have equal anchors. Stretches of
strings with one anchor travel together, and only those whose anchor occurs in two
documents travel at all. Where an anchor has several different stretches, their suffixes are
sorted and intervals of the Burrows-Wheeler transform are extended backwards breadth-first,
which gives common prefixes by increasing length, up to ``least``: suffixes that no shorter
prefix parts share a string.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import chunks, stored
from replivote.llm.shingles import mixed

GRAM = 16
#: Bytes of text handled at once, of a group of documents, and of text per bucket of anchors.
PIECE, GROUP, BUCKET = 2 << 20, 4 << 20, 2 << 20
#: Bytes of stretches above which a bucket is dealt anew, string by string.
LARGE = 64 << 20


def anchors(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of string starts with one anchor: anchor's place, first start, number of starts.

    ``data`` holds documents end to end; no string crosses an end.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < least:
        return none, none, none
    value, size = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1), 1
    while size < GRAM:
        value = value[:-size] * np.uint32(0x85EBCA6B) + value[size:]
        value ^= value >> np.uint32(15)
        size *= 2
    width, reach = least - GRAM + 1, 1
    place = np.arange(len(value), dtype=np.int32)
    while reach < width:  # the smallest value of a widening window, the leftmost of equal ones
        step = min(reach, width - reach)
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.minimum(value[step:], value[:-step])
        reach += step
    inside = np.ones(len(place), dtype=bool)
    for end in ends[:-1]:
        inside[max(0, end - least + 1) : end] = False
    start = np.flatnonzero(inside)
    anchor = place[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return anchor[first].astype(np.int64), start[first], np.diff(np.append(first, len(start)))


def grams(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hashes of the grams at these places."""
    out = np.zeros(len(places), dtype=np.uint64)
    for half in range(0, GRAM, 8):
        word = np.zeros(len(places), dtype=np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | data[places + half + k]
        out = mixed(out * np.uint64(3) + word + np.uint64(half))
    return out


def _first_ranks(symbols: np.ndarray, least: int) -> tuple[np.ndarray, int]:
    """Ranks by as many symbols as fit into one number, and how many these are."""
    bits = int(symbols.max() + 1).bit_length()
    reach = max(1, min(least, 62 // bits))
    packed = np.zeros(len(symbols), dtype=np.int64)
    for k in range(reach):  # past the end counts as smallest
        packed <<= bits
        packed[: max(0, len(symbols) - k)] += symbols[k:] + 1
    return np.unique(packed, return_inverse=True)[1].astype(np.int64), reach


def common_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``text`` by ``least`` symbols, and the common prefix of each suffix with the one before.

    Prefixes of ``least`` and more are given as ``least``. Each round extends all open
    intervals of the transform backwards by every symbol in them; an interval that ends
    at a boundary not yet known gives it the round's length and stays open, others close.
    """
    if not len(text):
        return text, text
    text = np.append(text, text.min() - 1)  # an end mark of its own, the smallest suffix
    n = len(text)
    rank, reach = _first_ranks(np.unique(text, return_inverse=True)[1].astype(np.int64), least)
    while reach < least:  # ranks by doubled prefixes; past the end counts as smallest
        step = min(reach, least - reach)
        nxt = np.zeros(n, dtype=np.int64)
        nxt[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + nxt, return_inverse=True)[1].astype(np.int64)
        reach += step
    order = np.argsort(rank, kind="stable")
    last = text[order - 1]  # the transform; before the first symbol comes the end mark
    by_symbol = np.argsort(last, kind="stable")
    image = np.empty(n, dtype=np.int64)
    image[by_symbol] = np.arange(n)
    same = last[by_symbol[1:]] == last[by_symbol[:-1]]
    later, earlier = np.full(n, n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    later[by_symbol[:-1][same]] = by_symbol[1:][same]
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    prefix = np.full(n + 1, least, dtype=np.int64)
    prefix[0] = 0
    low, high = np.array([0]), np.array([n])
    for length in range(least):
        sizes = high - low
        total = int(sizes.sum())
        if not total:
            break
        owner = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        ends, starts = later[at] >= high[owner], earlier[at] < low[owner]
        e, s = at[ends], at[starts]
        e = e[np.lexsort((last[e], owner[ends]))]
        s = s[np.lexsort((last[s], owner[starts]))]
        top, bottom = image[e] + 1, image[s]
        fresh = prefix[top] == least
        prefix[top[fresh]] = length
        low, high = bottom[fresh], top[fresh]
    return order[1:], prefix[1:n]


def shared_strings(strings: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the class of equal ``least``-byte strings at each place of padded rows: row, place, class."""
    rows, width = strings.shape
    inside = np.arange(width + 1)[None] < sizes[:, None]
    text = np.zeros((rows, width + 1), dtype=np.int64)
    text[:, :width] = strings.astype(np.int64) + 1
    text = text * inside
    text = text[np.arange(width + 1)[None] <= sizes[:, None]]  # every row and one mark after it
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    order, prefix = common_prefixes(text, least)
    number = np.empty(len(text), dtype=np.int64)
    number[order] = np.cumsum(prefix < least)
    counts = sizes - least + 1
    row = np.repeat(np.arange(rows), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, place, number[starts[row] + place]


def group_of(key: Column, groups: int) -> Column:
    return F.pmod(key.bitwiseXOR(F.shiftright(key, 13)), F.lit(groups)).cast("long")


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return np.mod(keys ^ (keys >> 13), groups)


def _loaded(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, bytes end to end, and ends of the texts of a batch."""
    raw = [t or b"" for t in batch.column("text").to_pylist()]
    return batch.column("id").to_numpy(), np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([len(r) for r in raw])


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places by key."""
    order = np.argsort(keys, kind="stable")
    if len(order):
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for part in np.split(order, cuts):
            yield int(keys[part[0]]), part


def _range_rows(key: np.ndarray, start: np.ndarray, end: np.ndarray, groups: int) -> list[tuple]:
    """Ranges by group of documents."""
    return [
        (k, _packed(key[part]), start[part].astype(np.int32).tobytes(), end[part].astype(np.int32).tobytes())
        for k, part in _split(_group(key, groups))
    ]


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _packed(keys: np.ndarray) -> bytes:
    """Document keys as their smallest, a mark of the width, and distances of 4 bytes where they fit."""
    base = int(keys.min()) if len(keys) else 0
    narrow = not len(keys) or int(keys.max()) - base < 1 << 32
    return np.array([base, narrow], dtype=np.int64).tobytes() + (keys - base).astype(np.uint32 if narrow else np.int64).tobytes()


def _keys(column: pa.ChunkedArray | list[bytes]) -> np.ndarray:
    """Document keys of packed rows, end to end."""
    parts = [np.zeros(0, dtype=np.int64)]
    for raw in column.to_pylist() if hasattr(column, "to_pylist") else column:
        base, narrow = np.frombuffer(raw[:16], dtype=np.int64)
        parts.append(np.frombuffer(raw, dtype=np.uint32 if narrow else np.int64, offset=16).astype(np.int64) + base)
    return np.concatenate(parts)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, KINDS[k]) for c, k in zip(columns, kinds)], names=list(names))


MARKS = "key long, keys binary, grams binary"
RANGES = "key long, keys binary, starts binary, ends binary"


def _tag(gram: np.ndarray, buckets: int) -> np.ndarray:
    """What is kept of an anchor's hash: its upper half, and its bucket."""
    return (gram >> np.uint64(32) << np.uint64(32)) | (gram % np.uint64(buckets))


def met(docs: DataFrame, least: int, groups: int, buckets: int, alone: bool) -> DataFrame:
    """``key, keys, grams``: anchors by bucket, each once per piece with its first document; or,
    ``alone``, by group of documents those that a piece alone shows to be in two documents.

    Both come from the texts: finding the anchors again costs less than storing them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "text", PIECE):
                ids, data, ends = _loaded(batch)
                place, _, _ = anchors(data, ends, least)
                key, gram = ids[np.searchsorted(ends, place, side="right")], grams(data, place)
                order = np.lexsort((key, gram))
                key, gram = key[order], gram[order]
                new = np.ones(len(gram), dtype=bool)
                new[1:] = (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])
                key, gram = key[new], gram[new]
                head = np.ones(len(gram), dtype=bool)
                head[1:] = gram[1:] != gram[:-1]
                runs = np.diff(np.append(np.flatnonzero(head), len(gram)))
                if alone:
                    twice = np.repeat(runs > 1, runs)
                    key, value = key[twice], _tag(gram[twice], buckets)
                    parts = _split(_group(key, groups))
                else:
                    key, value = key[head], (gram[head] >> np.uint64(32)).astype(np.uint32)
                    parts = _split((gram[head] % np.uint64(buckets)).astype(np.int64))
                yield from _table([(k, _packed(key[part]), value[part].tobytes()) for k, part in parts], MARKS).to_batches()

    return docs.mapInArrow(run, MARKS)


def repeated(docs: DataFrame, least: int, groups: int, buckets: int) -> DataFrame:
    """``key, keys, grams``: by group of documents, their anchors that occur in other documents too.

    An anchor adds one entry per piece of text that holds it, however often it does.
    """

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("key")[0].as_py()
        key, gram = _keys(table.column("keys")), _joined(table.column("grams"), np.uint32)
        order = np.lexsort((key, gram))
        key, gram = key[order], gram[order]
        head = np.ones(len(gram), dtype=bool)
        head[1:] = gram[1:] != gram[:-1]
        first = np.flatnonzero(head)
        runs = np.diff(np.append(first, len(gram)))
        several = key[first] != key[np.append(first[1:], len(gram)) - 1]
        take = np.repeat(several, runs)
        key, tag = key[take], ((gram.astype(np.uint64) << np.uint64(32)) | np.uint64(bucket))[take]
        return _table([(k, _packed(key[part]), tag[part].tobytes()) for k, part in _split(_group(key, groups))], MARKS)

    across = met(docs, least, groups, buckets, alone=False).groupBy("key").applyInArrow(run, MARKS)
    return across.union(met(docs, least, groups, buckets, alone=True))


def _rows_of(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Stretches as rows of ``width`` bytes, filled up with zeros."""
    at = start[:, None] + np.arange(width)[None]
    return np.where(np.arange(width)[None] < size[:, None], data[np.minimum(at, max(0, len(data) - 1))], 0).astype(np.uint8)


def _digest(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of padded rows."""
    width = -(-rows.shape[1] // 8) * 8
    full = np.zeros((len(rows), width), dtype=np.uint8)
    full[:, : rows.shape[1]] = rows
    words = full.view(np.uint64)
    a, b = size.astype(np.uint64), size.astype(np.uint64) + np.uint64(1 << 40)
    for k in range(words.shape[1]):
        a = mixed(a * np.uint64(0xD6E8FEB86659FD93) + words[:, k])
        b = mixed(b * np.uint64(0xA0761D6478BD642F) ^ words[:, k])
    return a, b


def _classes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=np.int64)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new) - 1
    return out


SENT = "kind int, key long, keys binary, starts binary, ends binary, sizes binary, offsets binary, bytes binary"
#: Offset of a string that is dealt by itself.
SINGLE = -1


def stretches(docs: DataFrame, marks: DataFrame, least: int, groups: int, buckets: int) -> DataFrame:
    """Stretches of repeated anchors by bucket (kind 0), and ranges already known to repeat by group (kind 1).

    Equal stretches of one piece travel once, with their first document: in the others every
    string of it repeats.
    """
    width = 2 * least - GRAM

    def run(texts: pa.Table, marked: pa.Table) -> pa.Table:
        known = np.unique(_joined(marked.column("grams"), np.uint64) ^ mixed(_keys(marked.column("keys")).view(np.uint64)))
        rows: list[tuple] = []
        for batch in texts.to_batches() if len(known) else ():
            for piece in chunks([batch], "text", PIECE):
                ids, data, ends = _loaded(piece)
                place, start, count = anchors(data, ends, least)
                doc = np.searchsorted(ends, place, side="right")
                gram = grams(data, place)
                take = np.isin(_tag(gram, buckets) ^ mixed(ids[doc].view(np.uint64)), known)
                place, start, count, doc, gram = (v[take] for v in (place, start, count, doc, gram))
                size = count + least - 1
                text = _rows_of(data, start, size, width)
                key, begin = ids[doc], start - (ends[doc] - np.diff(ends, prepend=0)[doc])
                later = _later(key, *_digest(text, size))
                rows += [(1, k, *v, None, None, None) for k, *v in _range_rows(key[later], begin[later], (begin + size)[later], groups)]
                bucket = np.where(later, -1, (gram % np.uint64(buckets)).astype(np.int64))
                rows += _stretch_rows(bucket, key, begin, size, place - start, text)
        return _table(rows, SENT)

    return docs.groupBy("key").cogroup(marks.groupBy("key")).applyInArrow(run, SENT)


def _later(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the same stretch is also in a document with a smaller key."""
    same = _classes(a, b)
    lowest = np.full(same.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, same, key)
    return key > lowest[same]


def _stretch_rows(bucket: np.ndarray, key: np.ndarray, begin: np.ndarray, size: np.ndarray, offset: np.ndarray, text: np.ndarray) -> list[tuple]:
    """Stretches by bucket; those without one (-1) are left out."""
    rows = []
    for k, part in _split(bucket):
        if k >= 0:
            inside = np.arange(text.shape[1])[None] < size[part][:, None]
            starts, sizes, offsets = begin[part].astype(np.int32), size[part].astype(np.int32), offset[part].astype(np.int32)
            rows.append((0, k, _packed(key[part]), starts.tobytes(), None, _small(sizes), _small(offsets), text[part][inside].tobytes()))
    return rows


def _small(values: np.ndarray) -> bytes:
    """Numbers in a byte each where all are from 0 to 255, which usual sizes and offsets are."""
    return (b"\1" + values.astype(np.uint8).tobytes()) if values.min(initial=0) >= 0 and values.max(initial=0) < 256 else b"\4" + values.tobytes()


def _numbers(column: list[bytes]) -> np.ndarray:
    parts = [np.frombuffer(v, np.uint8 if v[:1] == b"\1" else np.int32, offset=1).astype(np.int64) for v in column]
    return np.concatenate([np.zeros(0, dtype=np.int64), *parts])


def _near_another(text: np.ndarray, size: np.ndarray, offset: np.ndarray, least: int) -> np.ndarray:
    """Whether another of these different stretches agrees next to the anchor.

    A common string holds the anchor and ``least - GRAM`` bytes around it, so one half of
    that many agree on one side at least.
    """
    half = -(-(least - GRAM) // 2)
    near = np.zeros(len(size), dtype=bool)
    at = np.arange(GRAM + half)[None]
    for begin in (offset, offset - half):
        whole = np.flatnonzero((begin >= 0) & (begin + GRAM + half <= size))
        if len(whole):
            side = np.take_along_axis(text[whole], begin[whole][:, None] + at, axis=1)
            same = _classes(*_digest(side, np.full(len(whole), GRAM + half)))
            near[whole] |= np.bincount(same)[same] > 1
    return near


def judged(key: np.ndarray, start: np.ndarray, size: np.ndarray, offset: np.ndarray, data: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Ranges (key, start, end) of stretches that repeat strings of smaller documents among these stretches."""
    width = int(size.max(initial=least))
    text = _rows_of(data, np.cumsum(size) - size, size, width)
    same = _classes(*_digest(text, size))
    kinds = same.max(initial=-1) + 1
    lowest = np.full(kinds, np.iinfo(np.int64).max)
    np.minimum.at(lowest, same, key)
    sample = np.zeros(kinds, dtype=np.int64)
    sample[same] = np.arange(len(same))
    several = _near_another(text[sample], size[sample], offset[sample], least)
    plain = ~several[same] & (key > lowest[same])
    out = [(key[plain], start[plain], (start + size)[plain])]
    mixed_kinds = np.flatnonzero(several)
    if len(mixed_kinds):
        row, place, number = shared_strings(text[sample[mixed_kinds]], size[sample[mixed_kinds]], least)
        first = np.full(number.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, number, lowest[mixed_kinds][row])
        counts = size[sample[mixed_kinds]] - least + 1
        begin = np.cumsum(counts) - counts
        local = np.full(kinds, -1, dtype=np.int64)
        local[mixed_kinds] = np.arange(len(mixed_kinds))
        some = np.flatnonzero(several[same])
        kind = local[same[some]]
        who = np.repeat(some, counts[kind])
        step = np.arange(len(who)) - np.repeat(np.cumsum(counts[kind]) - counts[kind], counts[kind])
        repeats = first[number[np.repeat(begin[kind], counts[kind]) + step]] < key[who]
        who, step = who[repeats], step[repeats]
        new = np.ones(len(who), dtype=bool)
        new[1:] = (who[1:] != who[:-1]) | (step[1:] != step[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(who)) - 1
        out.append((key[who[heads]], start[who[heads]] + step[heads], start[who[tails]] + step[tails] + least))
    return tuple(np.concatenate(v) for v in zip(*out))


def dealt_anew(large: DataFrame, least: int, groups: int) -> DataFrame:
    """Stretches of large buckets cut into their strings, which are dealt by themselves.

    The parts of a bucket are in proportion to its size. Equal strings of one row travel once, with
    their first document; the others' ranges come out as rows of kind 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key, start, size = _keys([row["keys"]]), np.frombuffer(row["starts"], np.int32).astype(np.int64), _numbers([row["sizes"]])
                many = size - least + 1
                again = np.repeat(np.arange(len(size)), many)
                step = np.arange(len(again)) - np.repeat(np.cumsum(many) - many, many)
                full = np.full(len(again), least)
                text = _rows_of(np.frombuffer(row["bytes"], np.uint8), (np.cumsum(size) - size)[again] + step, full, least)
                a, b = _digest(text, full)
                key, start = key[again], start[again] + step
                later = _later(key, a, b)
                rows = [(1, k, *v, None, None, None) for k, *v in _range_rows(key[later], start[later], start[later] + least, groups)]
                part = np.where(later, -1, (a % np.uint64(row["parts"])).astype(np.int64))
                yield from _table(rows + _stretch_rows(part, key, start, full, np.full(len(again), SINGLE), text), SENT).to_batches()

    return large.mapInArrow(run, SENT)


def ranges(sent: DataFrame, least: int, groups: int, large: int) -> DataFrame:
    """``key, keys, starts, ends``: repeated ranges by group of documents."""

    def run(table: pa.Table) -> pa.Table:
        key, start = _keys(table.column("keys")), _joined(table.column("starts"), np.int32).astype(np.int64)
        size, offset = (_numbers(table.column(c).to_pylist()) for c in ("sizes", "offsets"))
        found = judged(key, start, size, offset, _joined(table.column("bytes"), np.uint8), least)
        return _table(_range_rows(*found, groups), RANGES)

    open_ = sent.where("kind = 0")
    settled = lambda rows: rows.where("kind = 1").select("key", "keys", "starts", "ends")
    sizes = open_.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("n")).where(F.col("n") > large)
    sizes = stored(sizes.select("key", (F.ceil(F.col("n") / large) * (2 * least)).cast("long").alias("parts")), "large")
    across = open_.join(sizes, "key", "left_anti").groupBy("key").applyInArrow(run, RANGES)
    done = across.union(settled(sent))
    if sizes.isEmpty():
        return done
    # parts of different large buckets may share a number: their strings differ, so nothing meets that should not
    single = stored(dealt_anew(open_.join(sizes, "key"), least, groups), "strings")
    return done.union(single.where("kind = 0").groupBy("key").applyInArrow(run, RANGES)).union(settled(single))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges as maximal runs, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return start[heads], reach[np.append(heads[1:], len(start)) - 1] if len(heads) else reach


REMOVED = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut(docs: DataFrame, repeats: DataFrame, with_text: bool) -> DataFrame:
    """Every document without its repeated ranges; ``kept`` is null unless asked for."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        key, start, end = _keys(found.column("keys")), *(_joined(found.column(c), np.int32).astype(np.int64) for c in ("starts", "ends"))
        order = np.argsort(key, kind="stable")
        key, start, end = key[order], start[order], end[order]
        rows = []
        for doc, text in zip(texts.column("id").to_pylist(), texts.column("text").to_pylist()):
            text = text or b""
            lo, hi = np.searchsorted(key, [doc, doc + 1]) if len(key) else (0, 0)
            a, b = merged(start[lo:hi], end[lo:hi])
            kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
            rows.append((doc, len(text), len(text) - len(kept), len(a), sha256(kept).hexdigest(), kept if with_text else None))
        columns = list(zip(*rows)) if rows else [()] * 6
        kinds = (*[pa.int64()] * 4, pa.string(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in REMOVED.split(", ")])

    return docs.groupBy("key").cogroup(repeats.groupBy("key")).applyInArrow(run, REMOVED)


def without_repeats(docs: DataFrame, least: int = 50, key: str = "doc_id", with_text: bool = False, large: int = LARGE) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``) for every row of ``docs (key, text)``.

    Every byte covered by a string of ``least`` bytes that also starts in a document with a
    smaller key is removed, judged on whole texts in UTF-8. Null text is empty. Rows with a
    null key are compared with nothing; rows that repeat a key together with its text
    are treated alike. ``least`` must be ``GRAM`` bytes or more. Other columns are not looked at.

    A text equal to that of a smaller key is removed whole (or kept, if shorter) and takes
    no further part: all its strings start in the smaller document too.
    """
    if least < GRAM:
        raise ValueError(f"strings of fewer than {GRAM} bytes have no anchor")
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(key).cast("long").alias("id"), data.alias("text"))
    told = rows.select("id", F.octet_length("text").cast("long").alias("n"), F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    lengths = told.where("id is not null")
    classes = lengths.groupBy("n", "k1", "k2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last and n > 0")
    copies = lengths.join(stored(classes, "classes"), ["n", "k1", "k2"]).where("id > first").select("id", "n").distinct()
    copies = stored(copies, "copies")
    total = told.agg(F.sum("n")).first()[0] or 0
    groups, buckets = total // GROUP + 1, total // BUCKET + 1
    kept = rows.where("id is not null").join(copies.select("id"), "id", "left_anti")
    keyed = kept.withColumn("key", group_of(F.col("id"), groups))
    sent = stored(stretches(keyed, repeated(kept, least, groups, buckets), least, groups, buckets), "stretches")
    done = cut(keyed, ranges(sent, least, groups, large), with_text)
    empty = sha256(b"").hexdigest()
    whole = F.col("n") >= least
    again = rows.where("id is not null").join(copies, "id")
    copied = again.select(
        "id",
        F.col("n").alias("n_bytes"),
        F.when(whole, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        whole.cast("long").alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.sha2("text", 256)).alias("kept_sha256"),
        (F.when(whole, F.lit(b"")).otherwise(F.col("text")) if with_text else F.lit(None).cast("binary")).alias("kept"),
    )
    unkeyed = rows.where("id is null").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), (F.col("text") if with_text else F.lit(None).cast("binary")).alias("kept"),
    )
    every = done.unionByName(copied).unionByName(unkeyed)
    return every.select(F.col("id").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []))
