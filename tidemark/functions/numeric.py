"""Ratios with exact decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EXACT = "decimal(22,2)"


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as DOUBLE, NULL when ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def rounded_ratio(part: Column, whole: Column, times: int = 1) -> Column:
    """``round(times * part / whole, 2)``, rounded half up once on decimals.

    NULL when ``whole`` is zero. A binary average could land on the wrong side
    of a half cent, so the quotient stays decimal until it is rounded.
    """
    numerator = (part.cast(_EXACT) * F.lit(times)).cast(_EXACT)
    quotient = numerator / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(quotient, 2).cast("decimal(24,2)")
