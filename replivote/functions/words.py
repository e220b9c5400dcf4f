"""Words of answers, counted in Python."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROWS = 64  # rows whose texts are Python strings at a time
_BYTES = 6 << 20  # of answers whose words are counted at a time


def split_words(text: str) -> list[str]:
    """Words between runs of white space, as ``functions.text.tokenize`` cuts them: white space at an end yields an empty word there."""
    words = text.split()
    if not text:
        return [""]
    if text[0].isspace():
        words.insert(0, "")
    if text[-1].isspace():
        words.append("")
    return words


def split_all(texts: pa.Array) -> pa.Array:
    """``split_words`` of many texts; Arrow alone makes two empty words of a run of white space at the end."""
    core = pc.utf8_rtrim_whitespace(texts)
    ended = pc.less(pc.binary_length(core), pc.binary_length(texts))
    return pc.utf8_split_whitespace(pc.if_else(ended, pc.binary_join_element_wise(core, " ", ""), core))


def _repeated(answers: list[str]) -> tuple[str, int, int]:
    """The words of all answers that occur more than once, in first-seen order, their number, and that of all words."""
    counts: Counter[str] = Counter()
    for answer, times in Counter(answers).items():
        words = split_words(answer)
        counts.update(words)
        if times > 1:
            counts.update(list(dict.fromkeys(words)))  # every word of an answer given twice is said twice
    shared = [word for word, n in counts.items() if n > 1]
    return " ".join(shared), len(shared), len(counts)


def repeated_words(answers: Column) -> Column:
    """``words, shared, distinct`` of an array of lower-cased answers without nulls; a null array has none."""

    @F.arrow_udf("struct<words: string, shared: int, distinct: int>")
    def repeated(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = [pa.string(), pa.int32(), pa.int32()]
        for rows in batches:
            # results leave in small batches, and a batch goes before the next one comes
            for at in range(0, len(rows), _ROWS):
                found = zip(*[_repeated(row or []) for row in rows.slice(at, _ROWS).to_pylist()])
                yield pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(found, kinds)], ["words", "shared", "distinct"])
            del rows

    # declared non-deterministic, so that it is planned once and as a step of its own
    return repeated.asNondeterministic()(answers)


def countable(answers: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ``counted_words`` can take these keys and this kind of order."""
    plain = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.DecimalType)
    order = answers.schema["_order"].dataType
    whole = isinstance(order, T.IntegralType) or (isinstance(order, T.DecimalType) and order.scale == 0 and order.precision <= 28)
    return whole and all(isinstance(answers.schema[k].dataType, plain) for k in keys)


def counted_words(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, ``_item, _ct, _order, _pos``: words of lower-cased answers ``_said``, counted and placed batch by batch.

    A key's words may come several times, to be added up; a row without a word has the number of its
    answers, 0 where all abstained.
    """
    order_kind = answers.schema["_order"].dataType
    out = T.StructType([T.StructField(k, answers.schema[k].dataType) for k in keys])
    out = out.add("_item", T.StringType()).add("_ct", T.LongType()).add("_order", order_kind).add("_pos", T.LongType())

    def counted(rows: pa.RecordBatch) -> pa.RecordBatch:
        which, first_rows = _numbered_keys([rows.column(i) for i in range(len(keys))], rows.num_rows)
        order_of, ranks = _ranked(rows.column("_order").to_pylist())
        said = rows.column("_said").dictionary_encode()
        spoke = np.flatnonzero(said.indices.is_valid().to_numpy(zero_copy_only=False))
        texts = said.indices.take(pa.array(spoke)).to_numpy(zero_copy_only=False).astype(np.int64)
        found = _counted(which[spoke], texts, ranks[spoke], said.dictionary, len(first_rows))
        key, item, counts, rank, place = found
        n = np.bincount(which[spoke], minlength=len(first_rows))
        at = pa.array(first_rows[np.concatenate([np.arange(len(first_rows)), key])])
        blank = len(first_rows)  # one row without a word per key
        orders = pa.array([None, *order_of], pa.int64() if pa.types.is_integer(rows.schema.field("_order").type) else rows.schema.field("_order").type)
        columns = [rows.column(i).take(at) for i in range(len(keys))]
        columns += [pa.concat_arrays([pa.nulls(blank, pa.string()), item]), pa.array(np.concatenate([n, counts]).astype(np.int64))]
        columns += [orders.cast(rows.schema.field("_order").type).take(pa.array(np.concatenate([np.zeros(blank, np.int64), rank + 1])))]
        columns += [pa.array(np.concatenate([np.zeros(blank, np.int64), place + 1]))]  # 0 is the place of the answer itself
        return pa.RecordBatch.from_arrays(columns, out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_said")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            share = (np.cumsum(sizes) - sizes) // _BYTES
            starts = np.flatnonzero(np.diff(share, prepend=-1))
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                yield counted(batch.slice(start, end - start))

    return answers.select(*keys, "_order", "_said").mapInArrow(run, out)


def _numbered_keys(columns: list[pa.Array], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's key, and a row of each key."""
    which = np.zeros(rows, dtype=np.int64)
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        which = np.unique(which * (codes.max(initial=0) + 1) + codes, return_inverse=True)[1]
    _, first, which = np.unique(which, return_index=True, return_inverse=True)
    return which, first


def _ranked(orders: list) -> tuple[list, np.ndarray]:
    """Different orders, rising, and each one's place among them; an answer without one comes last."""
    known = sorted({o for o in orders if o is not None}) + [None]
    places = {o: i for i, o in enumerate(known)}
    return known, np.array([places[o] for o in orders], dtype=np.int64)


def _counted(
    keys: np.ndarray, texts: np.ndarray, ranks: np.ndarray, spelt: pa.Array, n_keys: int
) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Key, word, count, first answer's rank and place in it, for every key and word of its answers.

    Equal answers are cut once, and count as often as a key has them; all else is done with numbers.
    """
    cut = split_all(spelt)
    words = cut.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    rising = np.argsort(ranks, kind="stable")  # so that the first of equal answers is the one that counts
    pairs, first, times = np.unique((keys * max(len(spelt), 1) + texts)[rising], return_index=True, return_counts=True)
    first = rising[first]
    order = np.argsort(ranks[first], kind="stable")
    key, text, rank, times = keys[first][order], texts[first][order], ranks[first][order], times[order]
    long = lengths[text]
    total = int(long.sum())
    place = np.arange(total) - np.repeat(np.cumsum(long) - long, long)
    number = np.repeat(key, long) * max(len(words.dictionary), 1) + codes[np.repeat(starts[text], long) + place]
    place += np.repeat(rank << 32, long)
    if len(np.unique(key * (rank.max(initial=0) + 1) + rank)) < len(key):  # answers of one order: the smaller place counts
        place_order = np.argsort(place, kind="stable")
    else:
        place_order = np.arange(total)
    cells = n_keys * max(len(words.dictionary), 1)
    if cells <= 8 * total + (1 << 20):
        counts = np.bincount(number, weights=np.repeat(times, long), minlength=cells).astype(np.int64)
        at = np.zeros(cells, dtype=np.int64)
        at[number[place_order[::-1]]] = place[place_order[::-1]]  # of several the last stays, which is the first place
        found = np.flatnonzero(counts)
        counts, at = counts[found], at[found]
    else:
        together = np.argsort(number, kind="stable")
        found, begins = np.unique(number[together], return_index=True)
        counts = np.add.reduceat(np.repeat(times, long)[together], begins) if len(found) else np.zeros(0, np.int64)
        at = np.minimum.reduceat(place[together], begins) if len(found) else np.zeros(0, np.int64)
    size = max(len(words.dictionary), 1)
    return found // size, words.dictionary.take(pa.array(found % size)), counts, at >> 32, at & 0xFFFFFFFF
