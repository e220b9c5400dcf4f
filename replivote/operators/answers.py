"""Common start of every vote over a long table: who spoke, and what was said how often."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replivote.functions import text


def plain_keys(operator: Callable) -> Callable:
    """Let a vote over ``(votes, keys, ...)`` take keys of any name: they are renamed on the way in and back."""

    @wraps(operator)
    def run(votes: DataFrame, keys: Sequence[str], *args, **options) -> DataFrame:
        if all(re.fullmatch(r"\w+", k) for k in keys):
            return operator(votes, keys, *args, **options)
        names = {k: f"_key{i}" for i, k in enumerate(keys)}
        voted = operator(votes.withColumnsRenamed(names), list(names.values()), *args, **options)
        return voted.withColumnsRenamed({v: k for k, v in names.items()})

    return run


def answers_of(votes: DataFrame, keys: Sequence[str], response: str, order: str, errors_vote: bool) -> DataFrame:
    """Keys, ``_order`` and ``_said`` (null where the answer is blank or may not vote)."""
    said = F.col(response)
    if not errors_vote:
        said = F.when(F.col("status") == "ok", said)
    spoken = F.when(~text.is_blank(said), said)
    return votes.select(*[F.col(f"`{k}`") for k in keys], F.col(order).alias("_order"), spoken.alias("_said"))


def distinct_answers(answers: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """One row per key and value: ``_value`` (null = abstained), ``_ct``, ``_first``."""
    return (
        answers.select(*keys, value.alias("_value"), "_order")
        .groupBy(*keys, "_value")
        .agg(F.count(F.lit(1)).alias("_ct"), F.min("_order").alias("_first"))
    )
