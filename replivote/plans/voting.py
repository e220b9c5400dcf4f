"""Consensus columns for annotated items: within models, between models, pooled."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.functions import votes
from replivote.functions.similarity import group_answers
from replivote.operators.annotate import voting_answers
from replivote.operators.once import with_computed
from replivote.operators.reshape import wide_answers


@dataclass(frozen=True)
class Voting:
    """Which votes to take and how; unset between values follow the within ones."""

    within: bool = True
    within_mode: str = "exact"
    within_threshold: float = 85
    between: bool = True
    between_mode: str | None = None
    between_threshold: float | None = None
    aggregate: bool = False
    aggregate_mode: str | None = None
    aggregate_threshold: float | None = None
    errors_vote: bool = False

    def __post_init__(self):
        for mode in (self.within_mode, self.mode_between, self.mode_pooled):
            votes.check_mode(mode)

    @property
    def mode_between(self) -> str:
        return self.within_mode if self.between_mode is None else self.between_mode

    @property
    def threshold_between(self) -> float:
        return self.within_threshold if self.between_threshold is None else self.between_threshold

    @property
    def mode_pooled(self) -> str:
        return self.within_mode if self.aggregate_mode is None else self.aggregate_mode

    @property
    def threshold_pooled(self) -> float:
        return self.within_threshold if self.aggregate_threshold is None else self.aggregate_threshold


def add_votes(annotated: DataFrame, models: int, voting: Voting) -> DataFrame:
    """Add ``_within`` (one struct per model), ``_pooled`` and ``_between`` as far as asked for.

    Each row carries its own answers, so this is a chain of projections without a
    shuffle. Answers are normalised once per mode in use.
    """
    modes = ([voting.within_mode] if voting.within else []) + ([voting.mode_pooled] if voting.aggregate else [])
    heard = voting_answers(F.col("answers"), F.col("failed"), voting.errors_vote)
    ready = {_prepared(mode): votes.prepare_once(F.col("_heard"), mode) for mode in modes}
    voted = with_computed(annotated.withColumn("_heard", heard), ready).drop("_heard")
    ballots: dict[str, tuple[Column, str, float]] = {}
    if voting.within:
        own = votes.by_model(F.col(_prepared(voting.within_mode)), models)
        ballots["_within"] = (own, voting.within_mode, voting.within_threshold)
    if voting.aggregate:
        every = F.array(F.col(_prepared(voting.mode_pooled)))
        ballots["_pooled"] = (every, voting.mode_pooled, voting.threshold_pooled)
    voted = _count(voted, ballots)
    if voting.aggregate:
        voted = voted.withColumn("_pooled", F.col("_pooled")[0])
    if voting.between and voting.within and models > 1:
        opinions = F.array(votes.prepare(F.col("_within.consensus"), voting.mode_between))
        voted = _count(voted, {"_between": (opinions, voting.mode_between, voting.threshold_between)})
        voted = voted.withColumn("_between", F.col("_between")[0])
    return voted.drop("_prepared_exact", "_prepared_set")


def _prepared(mode: str) -> str:
    return "_prepared_set" if mode == "set" else "_prepared_exact"


def _count(df: DataFrame, ballots: dict[str, tuple[Column, str, float]]) -> DataFrame:
    """Vote on each named array of ballots; similarity groups come first, they leave the JVM."""
    grouped = {f"{n}_groups": group_answers(b, t) for n, (b, mode, t) in ballots.items() if mode == "fuzzy"}
    ready = df.withColumns(grouped) if grouped else df
    counted = {
        n: votes.count_groups(F.col(f"{n}_groups"), t) if mode == "fuzzy" else votes.vote_each(b, mode)
        for n, (b, mode, t) in ballots.items()
    }
    return with_computed(ready, counted).drop(*grouped)


def long_votes(voted: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """Within-model votes as rows: keys, model, consensus, confidence, n_responses."""
    named = F.array(*[F.lit(m) for m in models])
    # the outer form: a plain explode would add a filter that votes twice
    each = voted.select(*keys, F.posexplode_outer("_within").alias("_at", "_v"))
    return each.select(*keys, named[F.col("_at")].alias("model"), "_v.consensus", "_v.confidence", "_v.n_responses")


def wide_result(voted: DataFrame, keys: Sequence[str], models: Sequence[str], runs: int) -> DataFrame:
    """Keys, answers run-major, consensus pairs by model, pooled and between pairs."""
    columns = [*[F.col(k) for k in keys], *wide_answers(F.col("answers"), models, runs)]

    def pair(vote: Column, name: str, suffix: str = "") -> list[Column]:
        return [vote["consensus"].alias(f"{name}{suffix}"), vote["confidence"].alias(f"{name}_Confidence{suffix}")]

    if "_within" in voted.columns:
        for i, m in enumerate(models):
            columns += pair(F.col("_within")[i], "Consensus", f" ({m})")
    if "_pooled" in voted.columns:
        columns += pair(F.col("_pooled"), "Aggregated_Consensus")
    if "_between" in voted.columns:
        columns += pair(F.col("_between"), "BetweenModel_Consensus")
    return voted.select(*columns)
