"""Alignment of two tokenizers over a corpus: shared cuts, overlapping tokens, counts of id pairs."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replivote.llm.common import chunks, quoted
from replivote.session import fresh_path

#: Bytes of text whose id pairs are counted together before they are shuffled.
PART = 4 << 20
#: Bytes of a tokenizer's file that may be sent to every executor.
LARGEST_FILE = 64 << 20
#: Characters of learned words kept by one task's tokenizer before it starts anew.
LEARNED = 3 << 20
#: Bytes of text that are aligned at a time.
BATCH = 512 << 10
#: What Unicode calls white space.
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space that does not follow a non-blank, or that ends the text.
_UNEVEN = re.compile(f"^ |[{_BLANK}] | \\Z")
#: A space and what follows up to the next space behind a non-blank.
_WORD = re.compile(f" (?:[^ ]+|(?<=[{_BLANK}]) )*+")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file of the ``tokenizers`` library. Strings of special tokens are plain text.

    ``apart``: its usual pattern never matches from a non-blank into a blank, nor looks further.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(file.decode())
        self.model.encode_special_tokens = True
        letters = _byte_letters()
        self.pieces = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab(with_added_tokens=False).items():
            self.pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pre = json.loads(self.model.pre_tokenizer.__getstate__()) if self.model.pre_tokenizer else {}
        usual = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.apart = bool(usual and self.model.normalizer is None)

    def encode(self, texts: list[str]) -> Iterator[Sequence[int]]:
        """Ids of a space and each text."""
        for at in range(0, len(texts), 1024):
            yield from (e.ids for e in self.model.encode_batch_fast([" " + t for t in texts[at : at + 1024]], add_special_tokens=False))


class Pieces:
    """A ``sentencepiece`` BPE model, which puts the space before a text itself.

    ``apart``: no piece holds a blank behind another letter and texts are taken as they are, so
    merges never cross from a letter into a blank.
    """

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        names = self.model.id_to_piece(list(range(self.model.vocab_size())))
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        probe = "  a  \ufb01\u2460 \u0301x\n "
        plain = b"".join(map(self.pieces.__getitem__, self.model.encode(probe))) == (" " + probe).encode()
        self.apart = plain and all("▁" not in p.lstrip("▁") for p in names)

    def encode(self, texts: list[str]) -> Iterator[Sequence[int]]:
        blank = [self.model.piece_to_id("▁")]
        yield from (ids or blank for ids in self.model.encode(texts, num_threads=1))


class _Numbered(dict):
    """Words numbered as they come; ``new`` lists those that are not learned yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Tokens:
    """Token ids of numbered words, end to end."""

    def __init__(self):
        self.ids, self.starts, self.odd = array("q"), array("q", [0]), array("b")

    def learn(self, tokenizer: ByteLevel | Pieces, words: list[str]) -> None:
        for word, ids in zip(words, tokenizer.encode(words)):
            self.ids.extend(ids)
            self.starts.append(len(self.ids))
            self.odd.append(b"".join(map(tokenizer.pieces.__getitem__, ids)) != (" " + word).encode())

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words one after another, how many each has, and whether they do not spell it."""
        starts, ids, odd = np.frombuffer(self.starts, np.int64), np.frombuffer(self.ids, np.int64), np.frombuffer(self.odd, bool)
        count = np.diff(starts)[numbers]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - starts[numbers], count)
        return ids[place], count, odd[numbers]


def _opened(name: str, file: bytes) -> ByteLevel | Pieces:
    return Pieces(file) if name.endswith(".model") else ByteLevel(file)


def sent(spark: SparkSession, path: str) -> tuple[str, Broadcast]:
    """A tokenizer's file for the executors; a path with a scheme is read by Spark, any other by the driver."""
    if "://" in path:
        file = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            file = f.read(LARGEST_FILE + 1)
    if len(file) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than a tokenizer's file may be")
    return path, spark.sparkContext.broadcast(file)


def ranks(short: np.ndarray, long: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each end of ``short``, the index of the first end of ``long`` that is not before it.

    Each end gallops through its text's stretch ``low`` to ``high`` of the longer list,
    from ``start`` on in doubling steps, upwards or downwards, until the step has passed it;
    the last step is then halved down to the place. All ends move in step with each
    other. The last end of every stretch must not be before the stretch's short ends.
    """
    at = np.clip(start, low, high - 1)
    up = long[at] < short
    below, above = np.where(up, at, low - 1), np.where(up, high - 1, at)
    for rising in (True, False):
        who = np.flatnonzero(up if rising else ~up)
        here, step = at[who], 1
        while len(who):
            there = here + step if rising else here - step
            inside = there < high[who] - 1 if rising else there >= low[who]
            passed = ~inside
            value = long[np.where(inside, there, here)]
            ends = inside & ((value >= short[who]) if rising else (value < short[who]))
            goes = inside & ~ends
            (above if rising else below)[who[ends]] = there[ends]
            (below if rising else above)[who[goes]] = there[goes]
            passed |= ends
            who, here, step = who[~passed], there[~passed], step * 2
    who = np.flatnonzero(above - below > 1)
    while len(who):
        mid = (below[who] + above[who]) >> 1
        less = long[mid] < short[who]
        below[who[less]], above[who[~less]] = mid[less], mid[~less]
        who = who[above[who] - below[who] > 1]
    return above


class Aligned(NamedTuple):
    """Texts laid end to end. Offsets have one entry more than there are texts."""

    a: np.ndarray  # token ids
    b: np.ndarray
    a_from: np.ndarray  # offsets of texts in a
    b_from: np.ndarray
    a_cuts: np.ndarray  # tokens of a up to each common end
    b_cuts: np.ndarray
    cuts_from: np.ndarray  # offsets of texts in the cuts
    link_a: np.ndarray  # places in a and b of tokens that overlap
    link_b: np.ndarray


def aligned_tokens(a: np.ndarray, b: np.ndarray, a_from: np.ndarray, b_from: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Common ends and overlaps of the two token lists of each text, which must cover the same bytes."""
    a_ends, b_ends = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    swap = len(b) < len(a)
    (short, s_from), (long, l_from) = ((b_ends, b_from), (a_ends, a_from)) if swap else ((a_ends, a_from), (b_ends, b_from))
    s_count, l_count = np.diff(s_from), np.diff(l_from)
    text = np.repeat(np.arange(len(s_count)), s_count)
    low, high = l_from[text], l_from[text + 1]
    first_byte = np.r_[0, short][s_from[:-1]]  # of each text; its last end is the one before the next
    span = np.r_[0, short][s_from[1:]] - first_byte
    start = low + (short - first_byte[text]) * l_count[text] // np.maximum(span[text], 1)
    place = ranks(short, long, start, low, high)
    shared = long[place] == short
    # the tokens of the longer list over one of the shorter go from the place of its start to that of its end
    first = np.r_[0, (place + shared)[:-1]] if len(place) else place
    times = place - first + 1
    link_s = np.repeat(np.arange(len(short)), times)
    link_l = np.arange(len(link_s)) - np.repeat(np.cumsum(times) - times - first, times)
    cut_s, cut_l = np.flatnonzero(shared) + 1, place[shared] + 1
    cuts_from = np.searchsorted(cut_s, s_from, side="right")
    if swap:
        return Aligned(a, b, a_from, b_from, cut_l, cut_s, cuts_from, link_l, link_s)
    return Aligned(a, b, a_from, b_from, cut_s, cut_l, cuts_from, link_s, link_l)


class Aligner:
    """Two opened tokenizers, what is worked out of them once, and the words learned so far.

    If both tokenizers keep words apart, a text is cut at every space behind a non-blank, its
    words are encoded once each, and its tokens are those of its words; else it is one word.
    """

    def __init__(self, first: tuple[str, Broadcast], second: tuple[str, Broadcast]):
        self.both = [_opened(name, file.value) for name, file in (first, second)]
        self.sizes = [np.array([len(p) for p in t.pieces], dtype=np.int64) for t in self.both]
        self.width = len(self.both[1].pieces)
        n, m = (len(t.pieces) for t in self.both)
        # what stands for a token in a group's text: its id, and what follows inside and at the end of its side
        self.names = np.array([f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)], dtype=object)
        self.apart = all(t.apart for t in self.both)
        self.learned = LEARNED  # so that the first texts start anew

    def words(self, text: str) -> list[str]:
        """Words of a space and the text, each without the space in front."""
        if not self.apart:
            return [text]
        if _UNEVEN.search(text):
            return [w[1:] for w in _WORD.findall(" " + text)]
        return text.split(" ")

    def align(self, texts: Sequence[str | None]) -> Aligned:
        """Texts that are null, empty, or not the bytes of their tokens have no tokens."""
        if self.learned >= LEARNED:
            self.known, self.tokens, self.learned = _Numbered(), [_Tokens() for _ in self.both], 0
        numbers, count = [np.zeros(0, dtype=np.int64)], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                words = self.words(text)
                count[i] = len(words)
                numbers.append(np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words)))
        for tokenizer, tokens in zip(self.both, self.tokens):
            tokens.learn(tokenizer, self.known.new)
        self.learned += sum(map(len, self.known.new))
        self.known.new = []
        numbers, text = np.concatenate(numbers), np.repeat(np.arange(len(texts)), count)
        sides = [tokens.of(numbers) for tokens in self.tokens]
        odd = np.zeros(len(texts), dtype=bool)
        odd[text[sides[0][2] | sides[1][2]]] = True
        ids, offsets = [], []
        for found, per_word, _ in sides:
            owner = np.repeat(text, per_word)
            if odd.any():
                found, owner = found[~odd[owner]], owner[~odd[owner]]
            ids.append(found)
            offsets.append(np.r_[0, np.cumsum(np.bincount(owner, minlength=len(texts)))])
        return aligned_tokens(*ids, *offsets, *self.sizes)

    def digests(self, done: Aligned) -> list[str]:
        """SHA-256 per text of its groups, ``a1,a2|b1;a3|b2,b3``; an empty string without tokens."""
        n, m = len(self.sizes[0]), self.width
        last_a, last_b = (np.zeros(len(x), dtype=np.int64) for x in (done.a, done.b))
        last_a[done.a_cuts - 1] = last_b[done.b_cuts - 1] = 1
        group_a, group_b = (np.cumsum(x) - x for x in (last_a, last_b))
        out = np.empty(len(done.a) + len(done.b), dtype=np.int64)
        out[np.arange(len(done.a)) + np.r_[0, done.b_cuts][group_a]] = done.a + n * last_a
        out[np.arange(len(done.b)) + np.r_[done.a_cuts, 0][group_b]] = done.b + 2 * n + m * last_b
        ends = done.a_from + done.b_from
        names = self.names[out].tolist()
        return [sha256("".join(names[s:e])[:-1].encode()).hexdigest() if e > s else "" for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _aligner(files: Sequence[tuple[str, Broadcast]]) -> Aligner:
    """The aligner of a worker process, opened once and kept with the first broadcast it was sent in."""
    held = files[0][1].__dict__
    if "aligner" not in held:  # each call sends its two files anew, so the first stands for both
        held["aligner"] = Aligner(*files)
    return held["aligner"]


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(quoted(text)).alias("_text"), F.col(quoted(key)).alias("_key"))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def alignment(docs: DataFrame, first: str, second: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, a_ids, b_ids, a_cuts, b_cuts`` per row: tokens of both files and the groups they form.

    A group ends where tokens of both end at the same byte; cuts count the tokens up to
    there, so group ``i`` holds ``a_ids[a_cuts[i-1]:a_cuts[i]]`` and the same of ``b``.
    Texts that are null or empty, or whose bytes (with a space in front) are not those of the
    tokens, have empty lists. Rows stay where they are, repeated keys included.
    """
    files = [sent(docs.sparkSession, f) for f in (first, second)]
    named = _named(docs, key, text)
    ints = T.ArrayType(T.IntegerType())
    kind = T.StructType([named.schema["_key"]] + [T.StructField(n, ints) for n in ("a_ids", "b_ids", "a_cuts", "b_cuts")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files)
        for batch in chunks(batches, "_text", BATCH):
            done = aligner.align(batch.column(0).to_pylist())
            texts = np.repeat(np.arange(batch.num_rows), np.diff(done.cuts_from))
            cuts = [_lists(c - f[texts], done.cuts_from) for c, f in ((done.a_cuts, done.a_from), (done.b_cuts, done.b_from))]
            yield pa.RecordBatch.from_arrays([batch.column(1), _lists(done.a, done.a_from), _lists(done.b, done.b_from), *cuts], kind.names)

    return named.mapInArrow(run, kind).withColumnRenamed("_key", key)


class _Part:
    """What is known of the texts of one part until all its id pairs are."""

    def __init__(self):
        self.keys, self.rows, self.pairs, self.times, self.counts, self.size = [], [], [], [], [], 0

    def add(self, keys: pa.Array, done: Aligned, digests: list[str], width: int) -> None:
        n = len(digests)
        text = np.searchsorted(done.a_from, done.link_a, side="right") - 1
        pair = done.a[done.link_a] * width + done.b[done.link_b]
        order = np.lexsort((pair, text)) if int(done.a.max(initial=0) + 1) * width * n >= 2**62 else np.argsort(text * (int(pair.max(initial=0)) + 1) + pair)
        pair, text = pair[order], text[order]
        new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])]) if len(pair) else np.zeros(0, dtype=np.int64)
        self.keys.append(keys)
        self.pairs.append(pair[new])
        self.times.append(np.diff(np.r_[new, len(pair)]))
        self.counts.append(np.bincount(text[new], minlength=n))
        self.rows.append((np.diff(done.a_from), np.diff(done.b_from), np.diff(done.cuts_from), np.bincount(text, minlength=n), digests))

    def finished(self, part: int, width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
        """A row per text, its pairs as steps between places in the part's sorted pairs; and one with those pairs."""
        pairs, times, counts = (np.concatenate(x) for x in (self.pairs, self.times, self.counts))
        known, place = np.unique(pairs, return_inverse=True)
        sums = np.bincount(place, weights=times, minlength=len(known)).astype(np.int64)
        ends = np.cumsum(counts)
        packed = [packed_counts(place[e - c : e], times[e - c : e]) for c, e in zip(counts.tolist(), ends.tolist())]
        keys = pa.concat_arrays(self.keys)
        rows = [np.concatenate([r[i] for r in self.rows]) for i in range(4)]
        n = len(keys)
        none = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], pa.int64()))
        columns = [pa.array(np.full(n, part)), pa.array(np.zeros(n, dtype=bool)), keys, *map(pa.array, rows)]
        columns += [pa.array([d for r in self.rows for d in r[4]]), pa.array(packed, pa.binary()), none, none, none]
        yield pa.RecordBatch.from_arrays(columns, names)
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64()))
        zero = [pa.array([0])] * 4
        total = [pa.array([part]), pa.array([True]), pa.nulls(1, keys.type), *zero, pa.array([""]), pa.array([b""], pa.binary())]
        yield pa.RecordBatch.from_arrays([*total, one(known // width), one(known % width), one(sums)], names)


def packed_counts(place: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places and how often each counts, in two or one byte each where that is enough, else in eight."""
    steps = np.diff(place, prepend=0)
    small = bool(not len(place) or (steps.max() < 1 << 16 and times.max() < 1 << 8))
    kinds = (np.uint16, np.uint8) if small else (np.uint64, np.uint64)
    return bytes([small]) + steps.astype(kinds[0]).tobytes() + times.astype(kinds[1]).tobytes()


def unpacked_counts(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    kinds = (np.dtype(np.uint16), np.dtype(np.uint8)) if packed[0] else (np.dtype(np.uint64), np.dtype(np.uint64))
    n = (len(packed) - 1) // (kinds[0].itemsize + kinds[1].itemsize)
    steps = np.frombuffer(packed, kinds[0], n, 1).astype(np.int64)
    return np.cumsum(steps), np.frombuffer(packed, kinds[1], n, 1 + n * kinds[0].itemsize).astype(np.int64)


def _encoded(docs: DataFrame, first: str, second: str, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows per text and rows per part, from one pass over the texts, written to the shared folder."""
    spark = docs.sparkSession
    files = [sent(spark, f) for f in (first, second)]
    named = _named(docs, key, text)
    long, ints = T.LongType(), T.ArrayType(T.LongType())
    kind = T.StructType([T.StructField("part", long), T.StructField("total", T.BooleanType()), named.schema["_key"]])
    for n in ("n_a", "n_b", "n_groups", "n_links"):
        kind = kind.add(n, long)
    kind = kind.add("groups_sha256", T.StringType()).add("links", T.BinaryType())
    kind = kind.add("a", ints).add("b", ints).add("n", ints)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, part, number = _aligner(files), _Part(), TaskContext.get().partitionId() << 32
        for batch in chunks(batches, "_text", BATCH):
            done = aligner.align(batch.column(0).to_pylist())
            part.add(batch.column(1), done, aligner.digests(done), aligner.width)
            part.size += batch.column(0).nbytes
            if part.size >= PART:
                yield from part.finished(number, aligner.width, kind.names)
                part, number = _Part(), number + 1
        if part.keys:
            yield from part.finished(number, aligner.width, kind.names)

    path = fresh_path(spark, "aligned")
    named.mapInArrow(run, kind).write.partitionBy("total").parquet(path)
    texts, parts = (spark.read.schema(kind).parquet(path) for _ in range(2))  # two scans, so that they can meet again
    return texts.where("not total").drop("total", "a", "b", "n"), parts.where("total").select("part", "a", "b", "n")


def pair_counts(parts: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each id pair, and whether no other pair of its ``b`` has more."""
    counts = parts.select(F.explode(F.arrays_zip("a", "b", "n")).alias("e")).groupBy("e.a", "e.b").agg(F.sum("e.n").alias("count"))
    path = fresh_path(parts.sparkSession, "pairs")
    counts.write.parquet(path)
    counts = parts.sparkSession.read.schema(counts.schema).parquet(path)
    top = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row per id of the second vocabulary
    return counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def scored_alignment(docs: DataFrame, first: str, second: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row.

    A link is a token of each file over a common byte. An id pair's count is the number of links of
    all texts that hold it; ``count_sum`` adds the counts of a text's links, ``n_best`` counts its links whose
    pair is the most counted of its second id, ties included. ``groups_sha256`` is the digest of the groups'
    ids in decimal, ``a1,a2|b1;a3|b2,b3``.

    Texts are encoded once; a stored row per text holds its distinct pairs as places in the pairs of its part
    (``PART`` bytes of text of one task, or one longer text). Only the pairs of whole parts are shuffled and
    counted, so a pair in every text moves once per part. Counts come back to the parts, not to the texts.

    Texts that are null or empty, or whose bytes (with a space in front) are not those of the tokens of both,
    give zeros and an empty digest. Rows with a null or repeated key are rows of their own and count as often
    as they are there; an empty table gives an empty result; other columns do not travel.
    """
    texts, parts = _encoded(docs, first, second, key, text)
    pairs = parts.select("part", F.explode(F.arrays_zip("a", "b")).alias("e")).select("part", "e.a", "e.b")
    weights = pairs.join(pair_counts(parts), ["a", "b"]).select("part", "a", "b", "count", "best")
    names = ["_key", "n_a", "n_b", "n_groups", "n_links"]
    kind = T.StructType([texts.schema[n] for n in names])
    kind = kind.add("n_best", T.LongType()).add("count_sum", T.LongType()).add("groups_sha256", T.StringType())

    def weigh(rows: pa.Table, known: pa.Table) -> pa.Table:
        columns = [known.column(c).to_numpy() for c in ("a", "b", "count", "best")]
        order = np.lexsort((columns[1], columns[0]))
        count, best = columns[2][order], columns[3][order].astype(np.int64)
        sums, bests = [], []
        for packed in rows.column("links").to_pylist():
            place, times = unpacked_counts(packed)
            sums.append(int(count[place] @ times) if len(place) else 0)
            bests.append(int(best[place] @ times) if len(place) else 0)
        added = [pa.array(bests, pa.int64()), pa.array(sums, pa.int64())]
        return pa.table([*[rows.column(n) for n in names], *added, rows.column("groups_sha256")], names=kind.names)

    done = texts.groupBy("part").cogroup(weights.groupBy("part")).applyInArrow(weigh, kind)
    return done.withColumnRenamed("_key", key)
