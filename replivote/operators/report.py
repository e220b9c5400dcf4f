"""Confidence bands, review list and run metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower limits of the high and the medium band.
HIGH = 0.7
MEDIUM = 0.4
BANDS = ("high", "medium", "low")


def band(confidence: Column) -> Column:
    """'high', 'medium' or 'low' for a rounded confidence."""
    return F.when(confidence >= HIGH, "high").when(confidence >= MEDIUM, "medium").otherwise("low")


def band_counts(results: DataFrame, confidence: str) -> DataFrame:
    """One row: n_high, n_medium, n_low."""
    of = band(F.col(f"`{confidence}`"))
    return results.agg(*[F.count(F.when(of == b, 1)).alias(f"n_{b}") for b in BANDS])


def confidence_bands(results: DataFrame, confidence: str) -> DataFrame:
    """One row per band, empty bands included."""
    counts = band_counts(results, confidence)
    listed = F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"n_{b}").alias("n_rows")) for b in BANDS])
    return counts.select(F.inline(listed))


def review_list(results: DataFrame, row: str, identifier: str, confidence: str) -> DataFrame:
    """Rows in the low band in row order: row number, identifier, per cent, ready-made line."""
    low = results.where(F.col(f"`{confidence}`") < MEDIUM).orderBy(F.col(f"`{row}`").cast("long"))
    percent = F.round(F.col(f"`{confidence}`") * 100, 1)
    line = F.format_string("Row %d: %s (confidence: %.1f%%)", F.col(row).cast("long"), F.col(f"`{identifier}`").cast("string"), percent)
    return low.select(
        F.col(row).cast("long").alias("row_number"),
        F.col(f"`{identifier}`").alias("identifier"),
        percent.alias("percent"),
        line.alias("line"),
    )


def duration_text(seconds: float) -> str:
    """Run time as ``{h}h {m}m {s}s``."""
    hours, rest = divmod(seconds, 3600)
    minutes, rest = divmod(rest, 60)
    return f"{int(hours)}h {int(minutes)}m {rest:.1f}s"


def run_metadata(
    results: DataFrame,
    confidence: str | None,
    *,
    prompt: str,
    models: Sequence[str],
    runs: int,
    delay: float = 0.0,
    within: bool = True,
    within_mode: str = "exact",
    within_threshold: float = 85,
    between: bool = True,
    between_mode: str | None = None,
    between_threshold: float | None = None,
    pooled: bool = False,
    pooled_mode: str | None = None,
    pooled_threshold: float | None = None,
    errors_vote: bool = False,
    duration_s: float | None = None,
) -> DataFrame:
    """One row describing a run; thresholds only where the mode is fuzzy."""
    between_mode = between_mode or within_mode
    between_threshold = within_threshold if between_threshold is None else between_threshold
    pooled_mode = pooled_mode or within_mode
    pooled_threshold = within_threshold if pooled_threshold is None else pooled_threshold

    def threshold(mode: str, value: float) -> Column:
        return F.lit(float(value) if mode == "fuzzy" else None).cast("double")

    counts = (
        band_counts(results, confidence)
        if confidence
        else results.limit(0).agg(*[F.lit(None).cast("long").alias(f"n_{b}") for b in BANDS])
    )
    return counts.select(
        F.lit(prompt).alias("prompt"),
        F.array(*[F.lit(m) for m in models]).alias("models"),
        F.lit(runs).alias("runs"),
        F.lit(float(delay)).alias("delay"),
        F.lit(within).alias("within_on"),
        F.lit(within_mode).alias("within_mode"),
        threshold(within_mode, within_threshold).alias("within_threshold"),
        F.lit(between).alias("between_on"),
        F.lit(between_mode).alias("between_mode"),
        threshold(between_mode, between_threshold).alias("between_threshold"),
        F.lit(pooled).alias("pooled_on"),
        F.lit(pooled_mode).alias("pooled_mode"),
        threshold(pooled_mode, pooled_threshold).alias("pooled_threshold"),
        F.lit(errors_vote).alias("errors_vote"),
        "n_high",
        "n_medium",
        "n_low",
        F.lit(duration_s).cast("double").alias("duration_s"),
        F.lit(None if duration_s is None else duration_text(duration_s)).cast("string").alias("duration"),
    )
