"""Similarity groups and fuzzy consensus over long answer tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from replivote.functions import text
from replivote.functions.rounding import ratio3
from replivote.functions.similarity import SHORT, first_leaders, group_leaders, ordered_leaders, token_set_ratio
from replivote.functions.votes import group_weight, vote_groups
from replivote.operators.answers import answers_of, distinct_answers, plain_keys
from replivote.session import checkpointed, written

BLOCK = 512  # distinct answers of one key that a single task groups at a time
_SHORT_SETS = 64  # short sets of words that count as one of any length: most are refused by their masks
_NEIGHBOURS = 8  # sets of words that meet a block's leaders in one task


def pair_similarity(pairs: DataFrame, left: str, right: str, score: str = "score") -> DataFrame:
    """Add the 0 to 100 token-set similarity of two text columns."""
    return pairs.withColumn(score, token_set_ratio(F.col(left), F.col(right)))


def _distinct(votes: DataFrame, keys, response, order, errors_vote) -> DataFrame:
    answers = answers_of(votes, keys, response, order, errors_vote)
    return distinct_answers(answers, keys, text.normalize(F.col("_said")))


def _gathered(distinct: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """One row per key with its (bounded) distinct answers in order and their leaders' positions."""
    row = F.when(F.col("_value").isNotNull(), F.struct("_first", "_value", "_ct"))
    gathered = distinct.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    return gathered.withColumn("_lead", group_leaders(F.transform("_rows", lambda r: r["_value"]), threshold))


def _block_groups(distinct: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Group each key's (bounded) distinct answers; adds the leader and its first position."""
    each = _gathered(distinct, keys, threshold).select(*keys, "_rows", "_lead", F.posexplode("_rows").alias("_at", "_row"))
    leader = F.col("_rows")[F.col("_lead")[F.col("_at")]]
    return each.select(
        *keys,
        F.col("_row._value").alias("_value"),
        F.col("_row._ct").alias("_ct"),
        F.col("_row._first").alias("_first"),
        leader["_value"].alias("_leader"),
        leader["_first"].alias("_leader_first"),
    )


def _block_consensus(distinct: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Vote within each key's (bounded) distinct answers; keys where all abstained stay."""
    groups = F.transform(
        "_rows",
        lambda r, i: F.struct(r["_value"].alias("value"), r["_ct"].alias("ct"), F.col("_lead")[i].alias("leader")),
    )
    voted = _gathered(distinct, keys, threshold).select(*keys, vote_groups(groups, threshold).alias("_vote"))
    return voted.select(*keys, "_vote.consensus", "_vote.confidence", "_vote.n_responses")


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys]


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in df.columns if c not in keys])


def _word_sets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_sid, _at, _set`` per key: answers of one set of words, which score alike against all others.

    ``_at`` is the place of its first answer. The id is a digest of 256 bits.
    """
    sets = F.array_join(F.array_sort(F.array_distinct(F.split("_value", " "))), " ")
    named = rows.select(*keys, F.sha2(sets, 256).alias("_sid"), sets.alias("_set"), F.struct("_first", "_value").alias("_at"))
    # the set itself is not moved for every answer: the first answer spells it, too
    first = named.groupBy(*keys, "_sid").agg(F.min("_at").alias("_at"))
    again = F.array_join(F.array_sort(F.array_distinct(F.split("_at._value", " "))), " ")
    return first.select(*keys, "_sid", "_at", again.alias("_set"))


def _numbered(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_sid, _set, _n, _weight``: sets of words with numbers that rise, with gaps, in answer order within each key.

    Ranges are drawn by the start of a text only, so that no whole text goes to the driver; equal starts stay together.
    """
    start = [F.col("_at._first"), F.substring("_at._value", 1, 32)]
    dealt = sets.repartitionByRange(*keys, *start).sortWithinPartitions(*keys, "_at", "_sid")
    weight = F.when(F.length("_set") <= SHORT, F.lit(1)).otherwise(F.lit(_SHORT_SETS)).cast("long")
    return dealt.select(*keys, "_sid", "_set", F.monotonically_increasing_id().alias("_n"), weight.alias("_weight"))


def _cuts(left: DataFrame, keys: Sequence[str], block: int) -> DataFrame:
    """``_cut`` per key: sets of smaller numbers weigh no more than a block; found over spans of numbers, not over sets."""
    span = max(1, block // 8)  # the sets of one span always fit
    spans = left.groupBy(*keys, F.expr(f"_n div {span}").alias("_span")).agg(F.sum("_weight").alias("_sum"))
    so_far = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_span"))
    within = spans.withColumn("_so_far", so_far).where(F.col("_so_far") <= block * _SHORT_SETS)
    return within.groupBy(*keys).agg(((F.max("_span") + 1) * span).alias("_cut"))


def _group_large(rows: DataFrame, keys: Sequence[str], threshold: float, block: int) -> DataFrame:
    """Group keys of any size, a block of possible leaders per round.

    What is grouped are sets of words, numbered once in answer order. The first block of each key,
    ``block`` sets or up to ``_SHORT_SETS`` times as many short ones, is grouped as it
    stands; all other sets of the key are dealt over slots of half a block (of less if they are short), each of which meets
    the block's leaders once, and join the first that they match. What matches none starts the
    next round. No leader of a later round can precede these, so the result equals
    one pass in answer order. Each round is written to the shared folder; sets that have found
    their leader do not travel again.
    """
    if threshold > 100:  # not even equal sets of words are alike
        return rows.select(*keys, "_value", "_ct", "_first", F.col("_value").alias("_leader"), F.col("_first").alias("_leader_first"))
    spark = rows.sparkSession
    rows = written(rows, "answers")
    # stated numbers: these rows are few bytes but much work, so they must not be merged;
    # several groups a core, as some hold much longer texts than others
    tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left = written(_numbered(_word_sets(rows, keys), keys), "sets")
    kind = {f.name: f.dataType for f in left.schema.fields}
    out = T.StructType([T.StructField(k, kind[k]) for k in (*keys, "_sid")]).add("_leader", T.StringType())
    pieces: list[DataFrame] = []

    def head(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_n", "ascending")])
        ids, sets = group.column("_sid").to_pylist(), group.column("_set").to_pylist()
        leaders = [ids[i] for i in ordered_leaders(sets, threshold)]
        return group.select([*keys, "_sid"]).append_column("_leader", pa.array(leaders, pa.string()))

    def others(group: pa.Table, block_of: pa.Table) -> pa.Table:
        group, block_of = group.sort_by([("_n", "ascending")]), block_of.sort_by([("_n", "ascending")])
        ids = block_of.column("_sid").to_pylist()
        found = first_leaders(block_of.column("_set").to_pylist(), group.column("_set").to_pylist(), threshold)
        leaders = pa.array([None if i is None else ids[i] for i in found], pa.string())
        return group.select([*keys, "_sid"]).append_column("_leader", leaders)

    while not left.isEmpty():
        cuts = _renamed(written(_cuts(left, keys, block), "cuts"), keys)
        cut = left.join(cuts, _same_key(left, cuts, keys)).drop(*[f"_r_{k}" for k in keys])
        block_rows = written(cut.where("_n < _cut").select(*keys, "_sid", "_set", "_n"), "block")
        grouped = written(block_rows.repartition(tasks, *keys).groupBy(*keys).applyInArrow(head, out), "heads")
        pieces.append(grouped)
        rest = cut.where("_n >= _cut").drop("_cut")
        share = F.sum(F.greatest("_weight", F.lit(4).cast("long"))) / F.lit(block * _SHORT_SETS)
        slots = rest.groupBy(*keys).agg(F.ceil(2 * share).cast("long").alias("_slots"))
        slots = _renamed(written(slots, "slots"), keys)
        if slots.isEmpty():
            break
        leads = _renamed(grouped.where("_sid = _leader"), keys).select(*[f"_r_{k}" for k in keys], F.col("_sid").alias("_q_sid"))
        leaders = block_rows.join(leads, [*_same_key(block_rows, leads, keys), block_rows["_sid"] == leads["_q_sid"]], "left_semi")
        dealt = leaders.join(slots, _same_key(leaders, slots, keys)).drop(*[f"_r_{k}" for k in keys])
        dealt = dealt.withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1))).drop("_slots")
        spread_out = rest.join(slots, _same_key(rest, slots, keys)).drop(*[f"_r_{k}" for k in keys])
        # neighbours in answer order, often of one text, stay together: what one is found to share bounds the others
        neighbours = F.xxhash64(F.expr(f"_n div {_NEIGHBOURS}"))
        spread_out = spread_out.withColumn("_slot", F.pmod(neighbours, F.col("_slots"))).select(*keys, "_slot", "_sid", "_set", "_n")
        dealt = dealt.select(*keys, "_slot", "_sid", "_set", "_n")
        both = [df.repartition(tasks, *keys, "_slot").groupBy(*keys, "_slot") for df in (spread_out, dealt)]
        tried = written(both[0].cogroup(both[1]).applyInArrow(others, out), "tried")
        pieces.append(tried.where(F.col("_leader").isNotNull()))
        open_ids = _renamed(tried.where(F.col("_leader").isNull()).select(*keys, "_sid"), keys)
        left = written(left.join(open_ids, [*_same_key(left, open_ids, keys), left["_sid"] == open_ids["_sid"]], "left_semi"), "sets")
    return _with_leaders(rows, pieces, keys)


def _with_leaders(rows: DataFrame, pieces: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Every answer with the first answer of its leader's set of words."""
    sets = F.array_join(F.array_sort(F.array_distinct(F.split("_value", " "))), " ")
    named = rows.withColumn("_sid", F.sha2(sets, 256))
    leader_of = _renamed(reduce(DataFrame.unionByName, pieces), keys).withColumnRenamed("_sid", "_q_sid")
    owned = named.join(leader_of, [*_same_key(named, leader_of, keys), named["_sid"] == leader_of["_q_sid"]]).select(*rows.columns, "_leader")
    firsts = named.groupBy(*keys, F.col("_sid").alias("_q_sid")).agg(F.min(F.struct("_first", "_value")).alias("_lead"))
    firsts = _renamed(firsts, keys)
    done = owned.join(firsts, [*_same_key(owned, firsts, keys), owned["_leader"] == firsts["_q_sid"]])
    return done.select(*keys, "_value", "_ct", "_first", F.col("_lead._value").alias("_leader"), F.col("_lead._first").alias("_leader_first"))


def _split_by_size(distinct: DataFrame, keys: Sequence[str], max_votes: int | None, block: int):
    """Answers of keys one task can group, and those of larger keys (None when there are none).

    A stated bound decides without looking; otherwise the distinct answers are
    checkpointed and counted per key.
    """
    if max_votes is not None and max_votes <= block:
        return distinct, None
    distinct = checkpointed(distinct)
    spoken = distinct.where(F.col("_value").isNotNull())
    large = spoken.groupBy(*keys).count().where(F.col("count") > block).drop("count")
    if large.isEmpty():
        return distinct, None
    many = _renamed(large, keys)
    small = distinct.join(many, _same_key(distinct, many, keys), "left_anti")
    return small, spoken.join(many, _same_key(spoken, many, keys), "left_semi")


@plain_keys
def greedy_groups(
    votes: DataFrame,
    keys: Sequence[str],
    *,
    threshold: float = 85,
    response="response",
    order="run",
    errors_vote=True,
    max_votes: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Similarity group of every distinct answer: keys, answer, leader, n_votes.

    In answer order, an answer joins the first group whose first member scores at
    least ``threshold``, else it opens a group. ``max_votes`` states a known bound
    on answers per key; without one the number of distinct answers is measured and
    keys above ``block`` are grouped in rounds.
    """
    small, large = _split_by_size(_distinct(votes, keys, response, order, errors_vote), keys, max_votes, block)
    groups = _block_groups(small, keys, threshold)
    if large is not None:
        groups = groups.unionByName(_group_large(large, keys, threshold, block))
    return groups.select(
        *keys, F.col("_value").alias("answer"), F.col("_leader").alias("leader"), F.col("_ct").alias("n_votes")
    )


@plain_keys
def consensus_fuzzy(
    votes: DataFrame,
    keys: Sequence[str],
    *,
    threshold: float = 85,
    response="response",
    order="run",
    errors_vote=True,
    max_votes: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Most frequent answer of the largest similarity group per key; confidence = the group's share.

    Bounds on the size of a key work as in ``greedy_groups``.
    """
    small, large = _split_by_size(_distinct(votes, keys, response, order, errors_vote), keys, max_votes, block)
    result = _block_consensus(small, keys, threshold)
    if large is not None:
        result = result.unionByName(_large_consensus(_group_large(large, keys, threshold, block), keys, threshold))
    return result


def _large_consensus(groups: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """The vote over grouped answers of any number, combined map-side."""
    by_group = (
        groups.withColumn("_weight", group_weight(F.col("_value"), F.col("_ct"), threshold))
        .groupBy(*keys, "_leader", "_leader_first")
        .agg(
            F.sum("_weight").alias("_size"),
            F.min_by("_value", F.struct(-F.col("_weight"), F.col("_first"))).alias("_modal"),
            F.sum("_ct").alias("_votes"),
        )
    )
    top = by_group.groupBy(*keys).agg(
        F.min_by("_modal", F.struct(-F.col("_size"), F.col("_leader_first"))).alias("consensus"),
        F.max("_size").alias("_best"),
        F.sum("_votes").alias("n_responses"),
    )
    return top.select(*keys, "consensus", ratio3(F.col("_best"), F.col("n_responses")).alias("confidence"), "n_responses")
