"""Consensus over the bounded array of answers one row holds (models x runs).

Each row votes on its own, so nothing is shuffled. For long tables, where one key
may own any number of answers, see ``operators.consensus``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from replivote.functions import text
from replivote.functions.rounding import ratio3
from replivote.functions.similarity import group_answers
from replivote.functions.words import repeated_words

MODES = ("exact", "set", "fuzzy")


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"{mode!r} is no way to vote; choose one of {', '.join(MODES)}")
    return mode


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use at several places of ``body``."""
    return F.transform(F.array(value), body)[0]


def _result(consensus: Column, confidence: Column, n: Column) -> Column:
    return F.struct(
        F.coalesce(consensus, F.lit("")).alias("consensus"),
        F.coalesce(confidence, F.lit(0.0)).alias("confidence"),
        n.cast("long").alias("n_responses"),
    )


def prepare(answers: Column, mode: str) -> Column:
    """Normalise every answer for ``mode``; null and blank ones become null and abstain."""
    return F.transform(answers, _shaped(mode))


def _shaped(mode: str) -> Callable[[Column], Column]:
    shape = text.split_set if check_mode(mode) == "set" else text.normalize
    return lambda a: F.when(~text.is_blank(a), shape(a))


def prepare_once(answers: Column, mode: str) -> Column:
    """``prepare`` with equal answers normalised once; to be a finished column before it crosses to Python."""
    return _shaped_once(answers, _shaped(mode))


def light_once(answers: Column) -> Column:
    """Answers lightly normalised, equal ones once; to be a finished column as well."""
    return _shaped_once(answers, text.normalize_light)


def _shaped_once(answers: Column, shape: Callable[[Column], Column]) -> Column:
    return _let(
        F.array_distinct(answers),
        lambda said: _let(
            F.struct(said.alias("said"), F.transform(said, shape).alias("shaped")),
            lambda o: F.transform(answers, lambda a: F.get(o["shaped"], (F.array_position(o["said"], a) - 1).cast("int"))),
        ),
    )


def of_model(answers: Column, models: int, index: int) -> Column:
    """One model's answers, in run order, from a run-major array."""
    return F.filter(answers, lambda _, i: i % models == index)


def by_model(prepared: Column, models: int) -> Column:
    """A run-major array cut into one array per model."""
    return F.array(*[of_model(prepared, models, m) for m in range(models)])


def _spoken(prepared: Column) -> Column:
    return F.filter(prepared, lambda a: a.isNotNull())


def _tally(values: Column) -> Column:
    """Distinct values in first-seen order with counts; the larger struct wins, earlier on ties.

    Sorting brings equal values together, so long answers cost n log n, not n squared.
    """

    def count_runs(ordered: Column) -> Column:
        starts = F.filter(
            F.transform(ordered, lambda v, i: F.struct(v["value"].alias("value"), v["pos"].alias("pos"), i.alias("at"))),
            lambda v, i: (i == 0) | (F.get(ordered, i - 1)["value"] != v["value"]),
        )
        return _let(
            starts,
            lambda heads: F.sort_array(
                F.transform(
                    heads,
                    lambda h, i: F.struct(
                        h["pos"].alias("pos"),
                        (F.coalesce(F.get(heads, i + 1)["at"], F.size(ordered)) - h["at"]).alias("ct"),
                        h["value"].alias("value"),
                    ),
                )
            ),
        )

    positioned = F.sort_array(F.transform(values, lambda v, i: F.struct(v.alias("value"), i.alias("pos"))))
    return F.transform(
        _let(positioned, count_runs),
        lambda t, i: F.struct(t["ct"].alias("ct"), (-i).alias("rank"), t["value"].alias("value")),
    )


def _modal(normalized: Column, empty: str | None = None) -> Column:
    return _let(
        normalized,
        lambda norms: _let(
            F.array_max(_tally(norms)),
            lambda top: _result(
                top["value"] if empty is None else F.coalesce(top["value"], F.lit(empty)),
                ratio3(top["ct"], F.size(norms)),
                F.size(norms),
            ),
        ),
    )


def vote_exact(prepared: Column) -> Column:
    """Most frequent answer, first seen on ties; confidence = its share."""
    return _modal(_spoken(prepared))


_KINDS = 32  # different sets up to which counting set by set beats sorting all items


def _tally_sets(sets: Column) -> Column:
    """Distinct items of lists of distinct items, first seen first, as ``key`` with the lists that hold it as ``value``."""

    def by_kind(kinds: Column) -> Column:
        weighed = F.transform(kinds, lambda k: F.struct(k.alias("set"), F.size(F.filter(sets, lambda s: s == k)).alias("ct")))
        counted = F.aggregate(
            weighed,
            F.create_map().cast("map<string,int>"),
            lambda counts, k: F.map_zip_with(
                counts,
                F.map_from_arrays(k["set"], F.array_repeat(k["ct"], F.size(k["set"]))),
                lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
            ),
        )
        sorted_ = F.transform(_tally(F.flatten(sets)), lambda t: F.struct(t["value"].alias("key"), t["ct"].alias("value")))
        return F.when(F.size(kinds) <= _KINDS, F.map_entries(counted)).otherwise(sorted_)

    return _let(F.array_distinct(sets), by_kind)


def vote_set(prepared: Column) -> Column:
    """Items named by at least half of the answers, else the most named one."""

    def choose(sets: Column) -> Column:
        n = F.size(sets)
        most = lambda tally: F.array_max(
            F.transform(tally, lambda t, i: F.struct(t["value"].alias("ct"), (-i).alias("rank"), t["key"].alias("key")))
        )
        return _let(
            _tally_sets(sets),
            lambda tally: _let(
                F.filter(tally, lambda t: t["value"] * 2 >= n),
                lambda frequent: _let(
                    F.when((F.size(frequent) > 0) | (F.size(tally) == 0), frequent).otherwise(
                        F.transform(F.array(most(tally)), lambda t: F.struct(t["key"].alias("key"), t["ct"].alias("value")))
                    ),
                    lambda chosen: _let(
                        F.struct(F.aggregate(chosen, F.lit(0).cast("long"), lambda acc, t: acc + t["value"]).alias("named"), n.alias("n")),
                        lambda sums: _result(
                            F.array_join(F.transform(chosen, lambda t: t["key"]), ", "),
                            ratio3(sums["named"], F.size(chosen) * sums["n"]),
                            n,
                        ),
                    ),
                ),
            ),
        )

    return _let(_spoken(prepared), choose)


def vote_groups(groups: Column, threshold: float) -> Column:
    """Most frequent answer of the largest similarity group; confidence = the group's share.

    ``groups`` lists the distinct answers, first seen first: value, ct, leader.
    """

    def choose(bound: Column) -> Column:
        members = F.transform(
            bound,
            lambda g, i: F.struct(
                g["leader"].alias("leader"),
                group_weight(g["value"], g["ct"], threshold).alias("weight"),
                (-i).alias("rank"),
                g["value"].alias("value"),
            ),
        )
        n = F.aggregate(bound, F.lit(0).cast("long"), lambda acc, g: acc + g["ct"])
        return _let(members, lambda ms: _let(_largest_group(ms), lambda top: _let(n, lambda all_: _pick(ms, top, all_))))

    return _let(groups, choose)


def group_weight(value: Column, ct: Column, threshold: float) -> Column:
    """How many equal answers land in one group.

    Equal answers score 100, but two empty ones score 0, so those stay apart
    unless the threshold lets everything match.
    """
    together = F.when(value == "", F.lit(threshold <= 0)).otherwise(F.lit(threshold <= 100))
    return F.when(together, ct).otherwise(1)


def _largest_group(members: Column) -> Column:
    opened = F.filter(members, lambda m: m["leader"] == -m["rank"])
    return F.array_max(
        F.transform(
            opened,
            lambda head: F.struct(
                F.aggregate(
                    members,
                    F.lit(0).cast("long"),
                    lambda acc, m: acc + F.when(m["leader"] == head["leader"], m["weight"]).otherwise(0),
                ).alias("size"),
                head["rank"].alias("rank"),
                head["leader"].alias("leader"),
            ),
        )
    )


def _pick(members: Column, top: Column, n: Column) -> Column:
    modal = F.array_max(
        F.transform(
            F.filter(members, lambda m: m["leader"] == top["leader"]),
            lambda m: F.struct(m["weight"].alias("weight"), m["rank"].alias("rank"), m["value"].alias("value")),
        )
    )
    return _result(modal["value"], ratio3(top["size"], n), n)


def vote_each(ballots: Column, mode: str, threshold: float = 85) -> Column:
    """Consensus structs (consensus, confidence, n_responses), one per array of prepared answers."""
    if check_mode(mode) == "exact":
        return F.transform(ballots, vote_exact)
    if mode == "set":
        return F.transform(ballots, vote_set)
    return count_groups(group_answers(ballots, threshold), threshold)


def count_groups(grouped: Column, threshold: float) -> Column:
    """Consensus structs, one per list of grouped answers."""
    return F.transform(grouped, lambda groups: vote_groups(groups, threshold))


def vote(prepared: Column, mode: str, threshold: float = 85) -> Column:
    """Consensus struct for one array of prepared answers."""
    return vote_each(F.array(prepared), mode, threshold)[0]


def vote_simple(answers: Column) -> Column:
    """Most frequent lightly normalised answer; only nulls abstain."""
    return _modal(F.transform(_spoken(answers), text.normalize_light), "no responses")


def vote_words(answers: Column) -> Column:
    """Words said more than once, in first-seen order; score = their share of all words."""
    # letters are lowered here, words are counted where a hash table costs less than sorting them all
    return word_result(repeated_words(F.transform(_spoken(answers), F.lower)))


def word_result(repeated: Column) -> Column:
    """The word vote from repeated words and the numbers of those and of all words."""
    return _let(
        repeated,
        lambda c: F.struct(
            F.when(c["shared"] > 0, c["words"]).otherwise("no consensus").alias("consensus"),
            F.when(c["shared"] > 0, c["shared"] / F.nullif(c["distinct"], F.lit(0))).otherwise(0.0).alias("confidence"),
        ),
    )


def vote_words_documented(answers: Column) -> Column:
    """The documented word vote: no empty words, a lone answer is certain, modal answer as fallback."""
    spoken = F.transform(F.filter(answers, lambda a: ~text.is_blank(a)), text.normalize_light)
    return _let(F.struct(spoken.alias("said"), vote_words(spoken).alias("words")), lambda v: documented_choice(v["said"], v["words"]))


def documented_choice(said: Column, words: Column) -> Column:
    """The documented word vote from lightly normalised answers and the words that they share."""
    alone = F.struct(said[0].alias("consensus"), F.lit(1.0).alias("confidence"))
    modal = _let(_modal(said, "no consensus"), lambda w: F.struct(w["consensus"].alias("consensus"), w["confidence"].alias("confidence")))
    return F.when(F.size(said) == 1, alone).when(words["confidence"] > 0, words).otherwise(modal)
