"""Computed columns that later steps read but never recompute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns as a lateral view of one row.

    A filter on a plain computed column is pushed below it with the whole
    expression copied into the filter, and again at every step further down. The
    view's columns are finished values: filters on them stay above, filters on
    other columns still move down to the scan.
    """
    if not columns:
        return df
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
