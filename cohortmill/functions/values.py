"""Null and blank handling, and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)


def null_if_epoch(col: Column) -> Column:
    """1970-01-01 means "not happened yet" in the sources; make it NULL before comparing."""
    return F.when(col != F.lit(EPOCH), col)


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_nonblank(*cols: Column, default: str = "") -> Column:
    """First value that is neither NULL nor '', else ``default``; the result is never NULL."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(default))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end as minutes; NULL when either is missing."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(60.0)
