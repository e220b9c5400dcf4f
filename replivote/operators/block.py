"""Consensus over a block of answer columns of a finished wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.functions import votes
from replivote.functions.similarity import group_answers
from replivote.operators.once import with_computed
from replivote.operators.reshape import consensus_columns, numbered_responses, quoted


def is_error(answer: Column) -> Column:
    """True for the texts a failed call leaves in a stored table."""
    return answer.startswith("Error: ") | (answer == "Error occurred")


def consensus_for_block(
    wide: DataFrame,
    columns: Sequence[str],
    mode: str = "exact",
    threshold: float = 85,
    *,
    consensus: str = "Consensus",
    confidence: str = "Consensus_Confidence",
    errors_vote: bool = True,
) -> DataFrame:
    """Add the consensus of the named columns and its confidence; rows stay where they are."""
    votes.check_mode(mode)
    said = [quoted(c).cast("string") for c in columns]
    heard = said if errors_vote else [F.when(~is_error(a), a) for a in said]
    ready = with_computed(wide, {"_ready": votes.prepare_once(F.array(*heard), mode)})
    ballot = F.array("_ready")
    if mode == "fuzzy":
        grouped = ready.withColumn("_groups", group_answers(ballot, threshold))
        voted = with_computed(grouped, {"_votes": votes.count_groups(F.col("_groups"), threshold)})
    else:
        voted = with_computed(ready, {"_votes": votes.vote_each(ballot, mode)})
    return voted.select(
        *[quoted(c) for c in wide.columns],
        F.col("_votes")[0]["consensus"].alias(consensus),
        F.col("_votes")[0]["confidence"].alias(confidence),
    )


def pooled_consensus(wide: DataFrame, mode: str = "exact", threshold: float = 85, *, errors_vote: bool = True) -> DataFrame:
    """Consensus over every numbered answer column, in table order."""
    return consensus_for_block(
        wide,
        numbered_responses(wide.columns),
        mode,
        threshold,
        consensus="Aggregated_Consensus",
        confidence="Aggregated_Consensus_Confidence",
        errors_vote=errors_vote,
    )


def between_consensus(
    wide: DataFrame, models: Sequence[str], mode: str = "exact", threshold: float = 85, *, errors_vote: bool = True
) -> DataFrame:
    """Consensus over the within-model consensus columns."""
    return consensus_for_block(
        wide,
        consensus_columns(wide.columns, models),
        mode,
        threshold,
        consensus="BetweenModel_Consensus",
        confidence="BetweenModel_Consensus_Confidence",
        errors_vote=errors_vote,
    )
