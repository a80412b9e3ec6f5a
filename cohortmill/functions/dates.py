"""Calendar expressions: period bounds, keys and names. Weeks are ISO (Monday first)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("Day", "Week", "Month")

DateLike = Column | DataFrame | dt.date | str


def as_date(value: DateLike) -> Column:
    """A date literal, a column, or a one-cell DataFrame used as a scalar subquery."""
    if isinstance(value, DataFrame):
        return value.scalar()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def _col(d: str | Column) -> Column:
    return F.col(d) if isinstance(d, str) else d


def check_grain(grain: str) -> str:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    return grain


def period_start(grain: str, d: str | Column) -> Column:
    d = _col(d)
    return {"Day": d, "Week": F.trunc(d, "week"), "Month": F.trunc(d, "month")}[check_grain(grain)]


def period_end(grain: str, d: str | Column) -> Column:
    d = _col(d)
    return {"Day": d, "Week": F.date_add(F.trunc(d, "week"), 6), "Month": F.last_day(d)}[check_grain(grain)]


def iso_year(d: str | Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(d))


def iso_week(d: str | Column) -> Column:
    return F.weekofyear(_col(d))


def week_name(d: str | Column) -> Column:
    """'W1' .. 'W53'."""
    return F.concat(F.lit("W"), iso_week(d).cast("string"))


def week_key(d: str | Column) -> Column:
    """'2026-W01'."""
    return F.concat(iso_year(d).cast("string"), F.lit("-W"), F.lpad(iso_week(d).cast("string"), 2, "0"))


def month_key(d: str | Column) -> Column:
    """'2025-12'."""
    return F.date_format(_col(d), "yyyy-MM")


def month_name(d: str | Column) -> Column:
    """'Dec.'."""
    return F.concat(F.date_format(_col(d), "MMM"), F.lit("."))


def period_key(grain: str, d: str | Column) -> Column:
    d = _col(d)
    return {"Day": d.cast("string"), "Week": week_key(d), "Month": month_key(d)}[check_grain(grain)]


def period_name(grain: str, d: str | Column) -> Column:
    d = _col(d)
    return {"Day": d.cast("string"), "Week": week_name(d), "Month": month_name(d)}[check_grain(grain)]


def calendar_labels(d: str | Column) -> list[Column]:
    """calendar_year, iso_year, iso_week and iso_month of a date."""
    d = _col(d)
    return [
        F.year(d).alias("calendar_year"),
        iso_year(d).cast("int").alias("iso_year"),
        iso_week(d).cast("int").alias("iso_week"),
        F.month(d).alias("iso_month"),
    ]


def year_month(d: str | Column) -> Column:
    """Partition label 'yyyyMM'."""
    return F.date_format(_col(d), "yyyyMM")
