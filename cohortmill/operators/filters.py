"""Row filters shared by facts, reports and exports. All bounds are half-open: ``[lo, hi)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.functions.dates import DateLike, as_date

TASK_TIMES = ("START_TIME_", "CLAIM_TIME_", "END_TIME_")
TASK_DATES = ("task_start_date", "task_claim_date", "task_end_date")


def within(col: str, lo, hi) -> Column:
    return (F.col(col) >= lo) & (F.col(col) < hi)


def touching_window(df: DataFrame, lo, hi, cols: Sequence[str] = TASK_TIMES) -> DataFrame:
    """Rows opened, claimed or ended inside the window."""
    return df.where(reduce(or_, [within(c, lo, hi) for c in cols]))


def filters_of(**wanted: str | Sequence[str] | None) -> dict[str, list[str]]:
    """The dimension filters that filter anything, as lists of values; None, '' and 'ALL' mean no filter."""
    unknown = set(wanted) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"not a dimension: {sorted(unknown)}")
    given = {name: wanted.get(name) for name in DIMENSIONS}
    return {name: [value] if isinstance(value, str) else list(value) for name, value in given.items()
            if value is not None and value not in ("", "ALL")}


def filter_dims(df: DataFrame, **wanted: str | Sequence[str] | None) -> DataFrame:
    """Apply only the supplied dimension filters; None, '' and 'ALL' mean no filter."""
    for name, values in filters_of(**wanted).items():
        df = df.where(F.col(name).isin(values))
    return df


def status_on_day(df: DataFrame, day: DateLike, status: str = "all") -> DataFrame:
    """Tasks opened on ``day`` whose opening-day status is ``status`` ('todo', 'doing', 'done' or 'all')."""
    d = as_date(day)
    ended = F.coalesce(F.col("task_end_date") == d, F.lit(False))
    claimed = F.coalesce(F.col("task_claim_date") == d, F.lit(False))
    by_status = {"done": ended, "doing": ~ended & claimed, "todo": ~ended & ~claimed, "all": F.lit(True)}
    if status not in by_status:
        raise ValueError(f"status must be one of {sorted(by_status)}, got {status!r}")
    return df.where((F.col("task_start_date") == d) & by_status[status])


def touching_month(df: DataFrame, month: str, cutoff: str) -> DataFrame:
    """Tasks of one 'yyyy-MM' month: any event before the cutoff month, only the opening from it on."""
    first = F.lit(f"{month}-01").cast("date")
    following = F.add_months(first, 1)
    cols = TASK_DATES if month < cutoff[:7] else TASK_DATES[:1]
    return touching_window(df, first, following, cols)


def apply_retention(df: DataFrame, date_col: str, as_of: DateLike, years: int = 1) -> DataFrame:
    """Drop rows that are ``years`` old or older at ``as_of``."""
    return df.where(F.col(date_col) > F.add_months(as_date(as_of), -12 * years))
