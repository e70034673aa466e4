"""Rounding and ratio expressions with one agreed meaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact_round(value: Column, places: int) -> Column:
    """Round half away from zero on a DECIMAL, as numeric rounding does."""
    return F.round(value.cast("decimal(38,12)"), places)


def ratio(top: Column, bottom: Column, places: int | None = None) -> Column:
    """``top / bottom`` in DOUBLE, NULL where the bottom is zero."""
    out = top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    return out if places is None else exact_round(out, places)


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)
