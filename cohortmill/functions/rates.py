"""Percent expressions with a stated rule for a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _percent(part: Column, whole: Column) -> Column:
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))


def floor_rate(part: Column, whole: Column) -> Column:
    """Percent rounded down; NULL when the denominator is zero."""
    return F.floor(_percent(part, whole)).cast("int")


def capped_floor_rate(part: Column, whole: Column) -> Column:
    """100 once ``part >= whole`` (so 0 of 0 is 100), else rounded down and at most 99."""
    return F.when(part >= whole, F.lit(100)).otherwise(floor_rate(part, whole)).cast("int")


def rounded_rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percent rounded to ``digits``; NULL when the denominator is zero."""
    return F.round(_percent(part, whole), digits)


def ratio_or_zero(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``part * scale / whole``, and 0 when the denominator is not positive."""
    return F.when(whole > 0, part * F.lit(scale) / F.nullif(whole, F.lit(0))).otherwise(F.lit(0.0))


def percent_text(part: Column, whole: Column, digits: int = 1) -> Column:
    """'12.5%' (half-even on the double), or '-' when there is no denominator."""
    pattern = "0." + "0" * digits
    text = F.call_function("format_number", _percent(part, whole), F.lit(pattern))
    return F.when(whole > 0, F.concat(text, F.lit("%"))).otherwise(F.lit("-"))
