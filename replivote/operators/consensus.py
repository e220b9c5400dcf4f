"""Consensus over long answer tables, one row per answer, any number per key.

Every operator first counts distinct values per key with map-side combining, so a
key that owns a third of all rows leaves each task as a few partial rows. Ties go
to the value whose first answer has the smallest ``order`` value. When the input
is already hash-partitioned by (some of) the keys, nothing is shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, LongType, ShortType

from replivote.functions import text
from replivote.functions.rounding import ratio3
from replivote.functions.votes import check_mode, documented_choice, light_once, prepare_once, vote_set, vote_words, word_result
from replivote.functions.words import countable, counted_words, repeated_words
from replivote.operators.answers import answers_of, distinct_answers, plain_keys
from replivote.operators.fuzzy import consensus_fuzzy
from replivote.operators.once import with_computed
from replivote.session import written

GATHERED = 256  # answers of one key that are gathered in one row

def _modal_per_key(distinct: DataFrame, keys: Sequence[str], empty: str) -> DataFrame:
    counted = F.when(F.col("_value").isNotNull(), F.col("_ct"))
    top = distinct.groupBy(*keys).agg(
        F.min_by("_value", F.when(F.col("_value").isNotNull(), F.struct(-F.col("_ct"), F.col("_first")))).alias("_top"),
        F.max(counted).alias("_best"),
        F.coalesce(F.sum(counted), F.lit(0)).alias("n_responses"),
    )
    return top.select(
        *keys,
        F.coalesce("_top", F.lit(empty)).alias("consensus"),
        F.coalesce(ratio3(F.col("_best"), F.col("n_responses")), F.lit(0.0)).alias("confidence"),
        "n_responses",
    )


@plain_keys
def consensus_exact(
    votes: DataFrame, keys: Sequence[str], *, response="response", order="run", errors_vote=True
) -> DataFrame:
    """Most frequent normalised answer per key and its share."""
    answers = answers_of(votes, keys, response, order, errors_vote)
    return _modal_per_key(distinct_answers(answers, keys, text.normalize(F.col("_said"))), keys, "")


@plain_keys
def consensus_simple(votes: DataFrame, keys: Sequence[str], *, response="response", order="run") -> DataFrame:
    """Most frequent lightly normalised answer per key; blanks vote, nulls do not."""
    answers = votes.select(*keys, F.col(order).alias("_order"), F.col(response).alias("_said"))
    return _modal_per_key(distinct_answers(answers, keys, text.normalize_light(F.col("_said"))), keys, "no responses")


def _place(answers: DataFrame) -> Column:
    """Answer order, then position inside the answer, as one value that sorts that way.

    A 32-bit order and the position fit in one long, a 64-bit order or a whole number of up to 28
    digits in a decimal; both keep the counting in hash aggregation. Any other order type falls back
    to a struct, whose minimum sorts all items.
    """
    kind = answers.schema["_order"].dataType
    if isinstance(kind, DecimalType) and kind.scale == 0 and kind.precision <= 28:
        return (F.col("_order").cast("decimal(28,0)") * F.lit(1 << 32) + F.col("_pos")).cast("decimal(38,0)")
    if isinstance(kind, LongType):
        return (F.col("_order").cast("decimal(20,0)") * F.lit(1 << 32) + F.col("_pos")).cast("decimal(38,0)")
    if isinstance(kind, (ByteType, ShortType, IntegerType)):
        return F.col("_order").cast("long") * (1 << 32) + F.col("_pos")
    return F.struct("_order", "_pos")


def _items(answers: DataFrame, keys: Sequence[str], parts: Column) -> DataFrame:
    """Per key: one row per item with ``_ct`` and ``_first`` and, with a null item, the answer count."""
    listed = answers.select(*keys, "_order", "_said", F.concat(F.array(F.lit(None).cast("string")), parts).alias("_parts"))
    # the outer form: a plain explode would add a filter that splits every answer twice
    each = listed.select(
        *keys, "_order", F.col("_said").isNotNull().alias("_spoke"), F.posexplode_outer("_parts").alias("_pos", "_item")
    )
    return each.groupBy(*keys, "_item").agg(
        F.count(F.when(F.col("_spoke"), 1)).alias("_ct"), F.min(_place(answers)).alias("_first")
    )


def _word_items(answers: DataFrame, keys: Sequence[str], cut: Callable[[Column], Column]) -> DataFrame:
    """``_items`` of the words of lower-cased answers; ``cut`` cuts those whose keys or orders Python does not count."""
    if not countable(answers, keys):
        return _items(answers, keys, F.coalesce(cut(F.col("_said")), F.array().cast("array<string>")))
    counted = counted_words(answers, keys)
    return counted.groupBy(*keys, "_item").agg(F.sum("_ct").alias("_ct"), F.min(_place(counted)).alias("_first"))


@plain_keys
def consensus_set(
    votes: DataFrame,
    keys: Sequence[str],
    *,
    response="response",
    order="run",
    errors_vote=True,
    max_votes: int | None = None,
) -> DataFrame:
    """Items named by at least half of a key's answers, else its most named item.

    Keys of few answers vote in one row; ``votes`` are read twice to tell them. Answers of others are
    counted per key first, and only items that reach one half are gathered: no more than twice an answer's
    items, whatever the size of the key. ``max_votes`` is accepted for symmetry with the fuzzy vote and changes nothing.
    """

    def small(votes: DataFrame) -> DataFrame:
        rows = _gathered(answers_of(votes, keys, response, order, errors_vote), keys)
        ready = with_computed(rows, {"_sets": prepare_once(F.col("_all"), "set")}).drop("_all")
        voted = with_computed(ready, {"_vote": vote_set(F.col("_sets"))})
        return voted.select(*keys, "_vote.consensus", "_vote.confidence", "_vote.n_responses")

    return _in_rows(votes, keys, order, small, lambda votes: _set_of_many(votes, keys, response, order, errors_vote))


def _set_of_many(votes: DataFrame, keys: Sequence[str], response: str, order: str, errors_vote: bool) -> DataFrame:
    """``consensus_set`` for any number of answers per key."""
    answers = answers_of(votes, keys, response, order, errors_vote)
    parts = F.coalesce(text.split_set(F.col("_said")), F.array().cast("array<string>"))
    items = _items(answers, keys, parts)
    named = F.col("_item").isNotNull()
    per_key = items.groupBy(*keys).agg(
        F.max(F.when(~named, F.col("_ct"))).alias("n_responses"),
        F.max(F.when(named, F.col("_ct"))).alias("_best"),
        F.max(F.when(named, F.col("_first"))).alias("_last"),
    )
    often, top = F.col("_ct") * 2 >= F.col("n_responses"), F.col("_ct") == F.col("_best")
    # a key's row without an item stays, for keys that name none. The filter needs both sides and their places, so nothing
    # is pushed below the counting, and both sides share one shuffle of items. A hot key's items are on the left side alone
    wanted = F.when(named, (often | top) & (F.col("_first") <= F.col("_last"))).otherwise(F.col("n_responses").isNotNull())
    able = _left_join(items, per_key, keys).where(wanted)
    chosen = able.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(named & often, F.struct("_first", "_item", "_ct")))).alias("_chosen"),
        F.min_by("_item", F.when(named & top, F.col("_first"))).alias("_top"),
        F.max("_best").alias("_best"),
        F.max("n_responses").alias("n_responses"),
    )
    some = F.coalesce(F.size("_chosen") > 0, F.lit(False))
    total = F.aggregate("_chosen", F.lit(0).cast("long"), lambda acc, t: acc + t["_ct"])
    return chosen.select(
        *keys,
        F.when(some, F.array_join(F.transform("_chosen", lambda t: t["_item"]), ", "))
        .otherwise(F.coalesce("_top", F.lit("")))
        .alias("consensus"),
        F.when(some, ratio3(total, F.size("_chosen") * F.col("n_responses")))
        .otherwise(F.coalesce(ratio3(F.col("_best"), F.col("n_responses")), F.lit(0.0)))
        .alias("confidence"),
        "n_responses",
    )


def _left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe left join on the keys; ``right`` has one row per key."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    match = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, match, "left").drop(*[f"_r_{k}" for k in keys])


def _shared_words(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    word = F.col("_item").isNotNull()
    return words.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(word & (F.col("_ct") > 1), F.struct("_first", "_item")))).alias("_shared"),
        F.count(F.when(word, 1)).alias("_distinct"),
    )


def _word_result(shared: Column, distinct: Column) -> tuple[Column, Column]:
    some = F.size(shared) > 0
    return (
        F.when(some, F.array_join(F.transform(shared, lambda t: t["_item"]), " ")),
        F.when(some, F.size(shared) / F.nullif(distinct, F.lit(0))),
    )


def _by_size(votes: DataFrame, keys: Sequence[str], order: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Answers of keys that one row can hold in a stated order, and those of all other keys (None when there are none).

    The first have at most ``GATHERED`` answers, of which no two share an order and none lacks one. Keys and orders
    are counted by a job of their own, which reads no answer.
    """
    said = votes.groupBy(*keys, F.col(order).alias("_order")).agg(F.count(F.lit(1)).alias("_n"))
    plain = (F.sum("_n") <= GATHERED) & (F.max("_n") == 1) & (F.count("_order") == F.count(F.lit(1)))
    sizes = said.groupBy(*keys).agg(plain.alias("_plain"))
    some = sizes.agg(F.bool_and("_plain"), F.bool_or("_plain")).first()
    if some[0] or some[1] is None:
        return votes, None
    if not some[1]:
        return None, votes
    other = written(sizes.where("not _plain").select(*[F.col(k).alias(f"_r_{k}") for k in keys]), "keys")
    match = [votes[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]
    return votes.join(other, match, "left_anti"), votes.join(other, match, "left_semi")


def _in_rows(
    votes: DataFrame, keys: Sequence[str], order: str, small: Callable[[DataFrame], DataFrame], large: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Keys of few answers by ``small``, all others by ``large``."""
    few, many = _by_size(votes, keys, order)
    if many is None:
        return small(few)
    return large(many) if few is None else small(few).unionByName(large(many))


def _gathered(answers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key's answers in order as one array ``_all``, without those that abstain."""
    spoken = F.when(F.col("_said").isNotNull(), F.struct("_order", "_said"))
    rows = answers.groupBy(*keys).agg(F.sort_array(F.collect_list(spoken)).alias("_rows"))
    return rows.select(*keys, F.transform("_rows", lambda r: r["_said"]).alias("_all"))


@plain_keys
def consensus_words(votes: DataFrame, keys: Sequence[str], *, response="response", order="run") -> DataFrame:
    """Words said more than once, in first-seen order; score = shared / distinct words, unrounded.

    Keys of few answers vote in one row; others are counted word by word. ``votes`` are read twice.
    """

    def small(votes: DataFrame) -> DataFrame:
        answers = votes.select(*keys, F.col(order).alias("_order"), F.col(response).alias("_said"))
        voted = _gathered(answers, keys).select(*keys, vote_words(F.col("_all")).alias("_vote"))
        return voted.select(*keys, "_vote.consensus", "_vote.confidence")

    return _in_rows(votes, keys, order, small, lambda votes: _words_of_many(votes, keys, response, order))


def _words_of_many(votes: DataFrame, keys: Sequence[str], response: str, order: str) -> DataFrame:
    """``consensus_words`` for any number of answers per key."""
    answers = votes.select(*keys, F.col(order).alias("_order"), F.lower(response).alias("_said"))
    shared = _shared_words(_word_items(answers, keys, text.tokenize), keys)
    words, score = _word_result(F.col("_shared"), F.col("_distinct"))
    return shared.select(
        *keys, F.coalesce(words, F.lit("no consensus")).alias("consensus"), F.coalesce(score, F.lit(0.0)).alias("confidence")
    )


@plain_keys
def consensus_words_documented(votes: DataFrame, keys: Sequence[str], *, response="response", order="run") -> DataFrame:
    """The documented word vote: no empty words, a lone answer is certain, modal answer as fallback.

    Keys of few answers vote in one row; others are counted word by word. ``votes`` are read twice.
    """

    def small(votes: DataFrame) -> DataFrame:
        rows = _gathered(answers_of(votes, keys, response, order, errors_vote=True), keys)
        ready = with_computed(rows, {"_light": light_once(F.col("_all"))}).drop("_all")
        counted = ready.withColumn("_words", word_result(repeated_words(F.col("_light"))))
        voted = counted.select(*keys, documented_choice(F.col("_light"), F.col("_words")).alias("_vote"))
        return voted.select(*keys, "_vote.consensus", "_vote.confidence")

    return _in_rows(votes, keys, order, small, lambda votes: _documented_of_many(votes, keys, response, order))


def _documented_of_many(votes: DataFrame, keys: Sequence[str], response: str, order: str) -> DataFrame:
    """``consensus_words_documented`` for any number of answers per key."""
    answers = answers_of(votes, keys, response, order, errors_vote=True)
    answers = answers.withColumn("_said", text.normalize_light(F.col("_said")))
    shared = _shared_words(_word_items(answers, keys, lambda said: F.split(said, " ")), keys)
    whole = _modal_per_key(distinct_answers(answers, keys, F.col("_said")), keys, "no consensus")
    both = _left_join(whole, shared, keys)
    words, score = _word_result(F.col("_shared"), F.col("_distinct"))
    alone = F.col("n_responses") == 1
    return both.select(
        *keys,
        F.when(alone, F.col("consensus")).otherwise(F.coalesce(words, F.col("consensus"))).alias("consensus"),
        F.when(alone, 1.0).otherwise(F.coalesce(score, F.col("confidence"))).alias("confidence"),
    )


def _word_parts(words: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Shared words of each key, joined in first-seen order, as rows ``part, words`` of about ``size`` characters.

    The words are dealt by range of key and place, so a hot key's are spread over the partitions; each
    knows from the lengths before it, one row per partition and key, where its words belong.
    """
    order = [F.col("_first"), F.col("_item")]
    shared = words.where(F.col("_item").isNotNull() & (F.col("_ct") > 1)).select(*keys, *order)
    dealt = shared.repartitionByRange(*keys, *order).withColumn("_deal", F.spark_partition_id())
    dealt = written(dealt.withColumn("_long", F.length("_item") + F.lit(1).cast("long")), "shared_words")
    within = Window.partitionBy(*keys, "_deal").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_deal")
    lengths = dealt.groupBy(*keys, "_deal").agg(F.sum("_long").alias("_sum"))
    lengths = lengths.withColumn("_from", F.sum("_sum").over(earlier) - F.col("_sum")).drop("_sum")
    placed = dealt.withColumn("_at", F.sum("_long").over(within) - F.col("_long"))
    at = F.col("_at") + F.col("_from")
    dealt_keys = [*keys, "_deal"]
    numbered = _left_join(placed, lengths, dealt_keys).withColumn("part", F.floor(at / F.lit(size)).cast("long"))
    listed = numbered.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(F.struct("_first", "_item"))).alias("_words"))
    return listed.select(*keys, "part", F.array_join(F.transform("_words", lambda t: t["_item"]), " ").alias("_words"))


@plain_keys
def consensus_words_in_parts(
    votes: DataFrame, keys: Sequence[str], *, response="response", order="run", size: int = 1 << 20, documented: bool = False
) -> DataFrame:
    """The word vote with long results in numbered rows: ``part, consensus, confidence`` per key.

    No row holds more than ``size`` characters and one word, however many words a hot key's answers
    share. The parts of a key joined by blanks in order of ``part`` are the ``consensus`` of ``consensus_words``
    (or ``consensus_words_documented``). Parts rise from 0; a word longer than ``size`` leaves a gap after it.
    """
    if documented:
        answers = answers_of(votes, keys, response, order, errors_vote=True).withColumn("_said", text.normalize_light(F.col("_said")))
        cut = lambda said: F.split(said, " ")
        whole = _modal_per_key(distinct_answers(answers, keys, F.col("_said")), keys, "no consensus")
    else:
        answers = votes.select(*keys, F.col(order).alias("_order"), F.lower(response).alias("_said"))
        cut, whole = text.tokenize, None
    words = written(_word_items(answers, keys, cut), "words")
    word = F.col("_item").isNotNull()
    counts = words.groupBy(*keys).agg(
        F.count(F.when(word & (F.col("_ct") > 1), 1)).alias("_shared"), F.count(F.when(word, 1)).alias("_distinct")
    )
    some, other, score = F.col("_shared") > 0, F.lit("no consensus"), F.lit(0.0)
    if whole is not None:
        counts = _left_join(whole, counts, keys)
        some, other, score = some & (F.col("n_responses") != 1), F.col("consensus"), F.col("confidence")
        score = F.when(F.col("n_responses") == 1, 1.0).otherwise(score)
    counts = counts.select(
        *keys,
        F.coalesce(some, F.lit(False)).alias("_some"),
        other.alias("_other"),
        F.when(some, F.col("_shared") / F.col("_distinct")).otherwise(score).alias("confidence"),
    )
    # the left side holds all parts of a hot key: the adaptive planner splits it
    long = _left_join(_word_parts(words, keys, size), counts, keys).where("_some")
    single = counts.where("not _some").select(*keys, F.lit(0).cast("long").alias("part"), F.col("_other").alias("consensus"), "confidence")
    return long.select(*keys, "part", F.col("_words").alias("consensus"), "confidence").unionByName(single)


def consensus(votes: DataFrame, keys: Sequence[str], mode: str = "exact", threshold: float = 85, **options) -> DataFrame:
    """Consensus per key in one of the three modes."""
    if check_mode(mode) == "fuzzy":
        return consensus_fuzzy(votes, keys, threshold=threshold, **options)
    if mode == "exact":
        options.pop("max_votes", None)
        return consensus_exact(votes, keys, **options)
    return consensus_set(votes, keys, **options)
