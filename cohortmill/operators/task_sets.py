"""Distinct task sets as stored bitmaps: a dictionary gives string ids dense numbers, daily sets of these merge into any period.

Numbers follow the opening day, so the tasks of a day lie close together and a daily set takes few bitmap rows. Large days
come in parts that are numbered on their own, so no task numbers a hot day alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.functions.dates import period_start
from cohortmill.operators.cohort import BACKLOG_DAYS, CELL_KEYS
from cohortmill.operators.versions import merge_states, set_states, state_counts

OPENED = "opened"
# Sets that one task sorts, of 4 KB each, where hashing deals them evenly.
SETS_PER_TASK = 16_384


def unnumbered(dictionary: DataFrame | None, tasks: DataFrame) -> DataFrame:
    """(task_id, day) of tasks the dictionary does not hold, once each; the smallest day counts, NULL ids have no number."""
    new = tasks.where("task_id is not null").groupBy("task_id").agg(F.min("task_start_date").alias("day"))
    return new if dictionary is None else new.join(dictionary.select("task_id"), "task_id", "left_anti")


def number_ids(new: DataFrame, first: int, stage: Callable[[DataFrame], DataFrame], per_part: int = 1_000_000) -> DataFrame:
    """Dense numbers from ``first`` on for distinct (task_id, day) rows: by day, then by part of the day, then by id.

    A day has as many parts as it needs to hold about ``per_part`` rows each, whatever its size. The same rows always get the
    same numbers, so a task that is run again after a lost executor agrees with the others. Offsets are prefix sums of the
    counts per day and part: one row per day and one more per ``per_part`` rows.
    """
    rows = stage(new.select("task_id", "day"))
    needed = rows.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / per_part).alias("parts"))
    part = F.pmod(F.xxhash64("task_id"), F.col("parts")).alias("part")
    parted = stage(rows.join(needed.withColumnRenamed("day", "_day"), F.col("day").eqNullSafe(F.col("_day"))).select(
        "task_id", "day", part))
    counts = parted.groupBy("day", "part").agg(F.count(F.lit(1)).alias("held"))
    before = Window.orderBy(F.col("day").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("day").alias("_day"), F.col("part").alias("_part"),
                           F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("day", "part").orderBy("task_id"))
    same = F.col("day").eqNullSafe(F.col("_day")) & (F.col("part") == F.col("_part"))
    return parted.withColumn("rank", rank).join(starts, same).select(
        "task_id", (F.lit(first - 1) + F.col("start") + F.col("rank")).cast("bigint").alias("id"))


def opened_sets(fact: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The counted tasks of each opening day and levels as bitmaps, with ``id_bucket``; one fact row per task.

    Tasks without an id or an opening day are in no set; neither are those the dictionary does not hold.
    """
    counted = fact.where((F.col("is_excluded") == 0) & F.col("task_start_date").isNotNull())
    rows = counted.select("task_id", F.col("task_start_date").alias("snapshot_date"), *DIMENSIONS)
    return set_states(rows.join(dictionary, "task_id"), CELL_KEYS, "id", {OPENED: F.lit(True)})


def backlog_sets(opened: DataFrame, grain: str, days: int = BACKLOG_DAYS) -> DataFrame:
    """Per period and levels, the union of the rolling backlogs of its days that have an opening: bitmaps by ``id_bucket``.

    A daily set goes to every period that holds an opening day of the same levels on its own day or up to ``days`` - 1 days
    later. That is its own period, and the following one if the first opening there comes early enough: which is known from
    one day per period and levels, so sets are sent at most twice and never once per day.

    A set takes 4 KB unpacked, however few bytes it has in a file or shuffle, so Spark's partition sizes say nothing about a
    task's memory. The sets are therefore dealt by their number (``opened`` is a stored table), shuffled once and sorted once.
    """
    keys = ["period_start", *DIMENSIONS]
    day = F.col("snapshot_date")
    start, reached = period_start(grain, day), period_start(grain, F.date_add(day, days - 1))
    sent = opened.withColumn("period_start", F.explode(F.array_distinct(F.array(start, reached))))
    parts = 1 + 2 * opened.count() // SETS_PER_TASK
    group = Window.partitionBy(*keys).orderBy("id_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = start == F.col("period_start")
    near = sent.repartition(parts, *keys).withColumn("first_day", F.min(F.when(own, day)).over(group))
    inside = own | F.col("first_day").between(day, F.date_add(day, days - 1))
    return merge_states(near.where(inside), keys, [OPENED])


def backlog_totals(opened: DataFrame, grain: str, days: int = BACKLOG_DAYS) -> DataFrame:
    """Distinct tasks of these unions: what the summary calls ``acc_total_qty`` of weeks and months."""
    keys = ["period_start", *DIMENSIONS]
    return state_counts(backlog_sets(opened, grain, days), keys, [OPENED]).withColumnRenamed(OPENED, "acc_total_qty")
