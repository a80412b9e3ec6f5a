"""Cohort cells: one scan of the fact gives every counter the day, week and month KPIs need.

A *cell* is (opening date x five levels). Per cell the day/week/month statuses are disjoint, so exact counts
replace distinct sets, and seven ``open_k`` counters (still open k days after opening) replace exploding every
task over the seven days it stays in the rolling backlog. Everything downstream works on cells, whose number is
bounded by days x level combinations, not by tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.functions.dates import calendar_labels
from cohortmill.functions.status import settled

BACKLOG_DAYS = 7
SUFFIX = {"Day": "daily", "Week": "weekly", "Month": "monthly"}
STATES = ("todo", "doing", "done")
STATE_COLUMNS = tuple(f"{state}_{suffix}" for suffix in SUFFIX.values() for state in STATES)
NEVER_ENDED = 2_147_483_647
CELL_KEYS = ("snapshot_date", *DIMENSIONS)


def counted(fact: DataFrame) -> DataFrame:
    """Rows that enter KPIs."""
    return fact.where(F.col("is_excluded") == 0)


def _coded(fact: DataFrame) -> DataFrame:
    """Each counted task reduced to its keys, one small status code per grain and the days it stayed open.

    Working the dates out once, in a projection, keeps the aggregation's generated code to integer comparisons.
    """
    start, claim, end = F.col("task_start_date"), F.col("task_claim_date"), F.col("task_end_date")
    codes = [
        F.when(settled(grain, end, start), F.lit(2)).when(settled(grain, claim, start), F.lit(1)).otherwise(F.lit(0))
        .alias(f"_{suffix}")
        for grain, suffix in SUFFIX.items()
    ]
    days_open = F.coalesce(F.date_diff(end, start), F.lit(NEVER_ENDED)).alias("_days_open")
    return counted(fact).where(start.isNotNull()).select(start.alias("snapshot_date"), *DIMENSIONS, *codes, days_open)


def cohort_cells(fact: DataFrame, days: int = BACKLOG_DAYS) -> DataFrame:
    """One row per opening date and levels, from a fact with one row per task.

    A plain hash aggregation: partial counts are built before the shuffle, so a hot plant or line costs one
    row per input partition.
    """
    states = [
        F.count_if(F.col(f"_{suffix}") == code).alias(f"{state}_{suffix}")
        for suffix in SUFFIX.values() for code, state in enumerate(STATES)
    ]
    still_open = [F.count_if(F.col("_days_open") > k).alias(f"open_{k}") for k in range(days)]
    return _coded(fact).groupBy(*CELL_KEYS).agg(F.count(F.lit(1)).alias("total_task"), *states, *still_open)


def milestone(cells: DataFrame) -> DataFrame:
    """The nine cohort counters per opening date, with calendar labels."""
    return cells.select(*CELL_KEYS, *STATE_COLUMNS, *calendar_labels("snapshot_date"))


def _backlog_contributions(cells: DataFrame, days: int) -> DataFrame:
    """Each cell contributes to its opening date and the following days."""
    steps = F.array(*[
        F.struct(F.lit(k).alias("offset"), F.col(f"open_{k}").alias("still_open")) for k in range(days)
    ])
    return (
        cells.withColumn("_step", F.explode(steps))
        .withColumn("_day", F.date_add("snapshot_date", F.col("_step.offset")))
    )


def acc_rolling(cells: DataFrame, days: int = BACKLOG_DAYS) -> DataFrame:
    """Rolling backlog: tasks opened in the last ``days`` days, all of them and those still open that day."""
    return (
        _backlog_contributions(cells, days)
        .groupBy(F.col("_day").alias("snapshot_date"), *DIMENSIONS)
        .agg(F.sum("_step.still_open").alias("acc"), F.sum("total_task").alias("acc_total_task"))
        .select(*CELL_KEYS, "acc", "acc_total_task", *calendar_labels("snapshot_date"))
    )


def rolling_total(counts: DataFrame, by: Sequence[str], day: str, count: str, name: str, days: int = BACKLOG_DAYS) -> DataFrame:
    """Sum of daily counts over the last ``days`` days, on every day that has a count in them, per ``by``.

    Counts are added up per day first, so a hot group has as many rows as its calendar has days. Days without a count
    are filled in only as far as the frame still reaches a count; the frame itself is a range over day numbers, so each row
    is read once instead of once per day it counts for. Rows without a day are left out; a NULL count counts as zero.
    """
    dated = counts.where(F.col(day).isNotNull())
    per_day = dated.groupBy(*by, F.col(day).alias("_day")).agg(F.coalesce(F.sum(count), F.lit(0)).alias("_count"))
    in_order = Window.partitionBy(*by).orderBy("_day")
    until = F.date_add("_day", days - 1)
    last = F.least(until, F.date_sub(F.lead("_day").over(in_order), 1))
    filled = per_day.withColumn("_last", last).select(
        *by, "_day", "_count", F.explode(F.sequence("_day", "_last")).alias("_filled"))
    own = F.when(F.col("_filled") == F.col("_day"), F.col("_count")).otherwise(F.lit(0))
    frame = Window.partitionBy(*by).orderBy(F.unix_date("_filled")).rangeBetween(1 - days, Window.currentRow)
    return filled.select(*by, F.col("_filled").alias(day), F.sum(own).over(frame).alias(name))


def completion(milestones: DataFrame, backlog: DataFrame) -> DataFrame:
    """Milestone counters joined with the backlog of the same date and levels; total = todo + doing + done."""
    labels = ("calendar_year", "iso_year", "iso_week", "iso_month")
    return (
        milestones.join(backlog, [*CELL_KEYS, *labels], "left")
        .withColumn("total_task", F.col("todo_daily") + F.col("doing_daily") + F.col("done_daily"))
        .select(*CELL_KEYS, "total_task", *STATE_COLUMNS, "acc", "acc_total_task", *labels)
    )


def completion_from_cells(cells: DataFrame, days: int = BACKLOG_DAYS) -> DataFrame:
    """The same rows as ``completion`` in one aggregation: no join, and the fact is scanned once."""
    own = F.col("_step.offset") == 0
    counters = ("total_task", *STATE_COLUMNS)
    return (
        _backlog_contributions(cells, days)
        .groupBy(F.col("_day").alias("snapshot_date"), *DIMENSIONS)
        .agg(
            *[F.sum(F.when(own, F.col(c)).otherwise(F.lit(0))).alias(c) for c in counters],
            F.sum("_step.still_open").alias("acc"), F.sum("total_task").alias("acc_total_task"),
        )
        .where("total_task > 0")
        .select(*CELL_KEYS, *counters, "acc", "acc_total_task", *calendar_labels("snapshot_date"))
    )


def zero_open_days(backlog: DataFrame, completed: DataFrame) -> DataFrame:
    """Backlog rows of days on which nothing was opened for those levels."""
    return backlog.join(completed.select(*CELL_KEYS).distinct(), [*CELL_KEYS], "left_anti")

