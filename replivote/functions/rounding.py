"""Ratio rounded to three decimals the way the confidence values need it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = float(2**27 + 1)


def ratio3(part: Column, whole: Column) -> Column:
    """``part / whole`` to 3 decimals, rounding the binary quotient exactly.

    Away from a tie, whole-number arithmetic decides. On an exact decimal tie the
    stored double lies a little above or below it (or on it: then to even); the
    error-free product ``quotient * 2000`` shows which. Null when ``whole`` is 0.
    """
    part, whole = part.cast("long"), F.nullif(whole.cast("long"), F.lit(0))
    scaled = part * 1000
    rest = scaled % whole
    floor = ((scaled - rest) / whole).cast("long")
    quotient = part / whole
    product = quotient * 2000.0
    spread = quotient * _SPLITTER
    high = spread - (spread - quotient)
    error = (high * 2000.0 - product) + (quotient - high) * 2000.0
    side = (product - (floor * 2 + 1)) + error
    tie_up = (side > 0) | ((side == 0) & (floor % 2 == 1))
    up = (rest * 2 > whole) | ((rest * 2 == whole) & tie_up)
    return (floor + up.cast("long")) / 1000.0
