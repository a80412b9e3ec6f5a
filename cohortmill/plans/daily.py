"""Daily job: bronze tables to variables, fact and summary - a full build, or only what changed.

An incremental run recomputes the affected periods from the fact. It never adds to old numbers, so any split of a
period into runs gives the tables one full build gives.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateLike, year_month
from cohortmill.operators.cohort import BACKLOG_DAYS
from cohortmill.operators.dimensions import build_five_level
from cohortmill.operators.facts import TASK_KEYS, build_task_fact
from cohortmill.operators.filters import TASK_DATES, touching_window
from cohortmill.operators.summary import task_summary
from cohortmill.operators.variables import pivot_variables
from cohortmill.operators.versions import FLAG_REASON, latest_by_key
from cohortmill.plans import rollup_store
from cohortmill.plans.runs import affected_periods
from cohortmill.sources.ingest import in_window
from cohortmill.sources.tables import append_rows, overwrite_periods, path_exists, remove_partitions, stages

FACT_PARTITION = "start_month"
SUMMARY_PARTITIONS = ("period_type", "period_month")


@dataclass(frozen=True)
class Bronze:
    """The bronze tables the transforms read."""

    taskinst: DataFrame
    varinst: DataFrame
    procinst: DataFrame
    procdef: DataFrame
    employees: DataFrame
    line_desc: DataFrame
    prod_area: DataFrame
    mfg_plant: DataFrame
    factory_area: DataFrame
    mfg_site: DataFrame


def five_level(bronze: Bronze) -> DataFrame:
    return build_five_level(
        bronze.line_desc, bronze.prod_area, bronze.mfg_plant, bronze.factory_area, bronze.mfg_site
    )


def months_between(lo, hi) -> list[str]:
    """The 'yyyyMM' of ``[lo, hi)``."""
    first, last = (dt.datetime.fromisoformat(str(x)) for x in (lo, hi))
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    return [f"{first.year + (first.month - 1 + k) // 12}{(first.month - 1 + k) % 12 + 1:02d}" for k in range(count)]


def in_load_months(log: DataFrame, time_col: str, lo, hi) -> DataFrame:
    """Rows of ``[lo, hi)`` by the column a bronze table is laid out by: only their month folders are opened."""
    if "ym" in log.columns:
        log = log.where(F.col("ym").cast("string").isin(months_between(lo, hi)))
    return in_window(log, time_col, str(lo), str(hi))


def active_tasks(bronze: Bronze, lo, hi) -> DataFrame:
    """Keys of tasks opened, claimed or ended in ``[lo, hi)``, in any version."""
    bounds = [F.lit(str(x)).cast("timestamp_ntz") for x in (lo, hi)]
    return touching_window(bronze.taskinst, *bounds).select(*TASK_KEYS).distinct()


def touched_processes(bronze: Bronze, lo, hi) -> DataFrame:
    """Processes that got a variable or an instance row in ``[lo, hi)``.

    An instance row counts in the window of its own time, which the log is laid out by, and in that of its load: one that
    lands late, after its tasks, is found by the load. The second reads other months too, but Spark skips files by the
    time of their load, which is one value in each.
    """
    found = in_load_months(bronze.varinst, "CREATE_TIME_", lo, hi).select("PROC_INST_ID_")
    instance = F.col("ID_").alias("PROC_INST_ID_")
    if "START_TIME_" in bronze.procinst.columns:
        found = found.union(in_load_months(bronze.procinst, "START_TIME_", lo, hi).select(instance))
    landed = in_window(bronze.procinst, "_extracted_at", str(lo), str(hi))
    return found.union(landed.select(instance)).distinct()


def changed_tasks(bronze: Bronze, lo, hi) -> DataFrame:
    """Keys of tasks whose fact row may differ after the rows of ``[lo, hi)``.

    These are tasks updated in the window and tasks of processes that got a variable or an instance row in it. The
    conditions are on the columns the logs are loaded by, so a window opens only its months of the logs. The second needs a
    join of the task keys with the processes touched. Changed master data is found by ``plans.feed``.
    """
    updated = in_load_months(bronze.taskinst, "LAST_UPDATED_TIME_", lo, hi).select(*TASK_KEYS)
    of_touched = bronze.taskinst.select(*TASK_KEYS).join(touched_processes(bronze, lo, hi), "PROC_INST_ID_", "left_semi")
    return updated.union(of_touched.select(*TASK_KEYS)).distinct()


def task_fact(bronze: Bronze, updated_at, lo=None, hi=None, levels: DataFrame | None = None,
              only: DataFrame | None = None) -> DataFrame:
    """The fact of all tasks, of those active in ``[lo, hi)``, or of the task keys ``only``, with exclusions applied.

    ``levels`` is the stored five-level table; without it the table is derived from the master data in the query.
    """
    if lo is not None:
        only = active_tasks(bronze, lo, hi)
    # Of the processes in the window all revisions, whatever their age: a window gives what a full build gives.
    processes = None if only is None else only.select("PROC_INST_ID_")
    return build_task_fact(
        tasks=bronze.taskinst,
        pivot=pivot_variables(bronze.varinst, processes),
        five_level=five_level(bronze) if levels is None else levels,
        procinst=bronze.procinst, procdef=bronze.procdef, employees=bronze.employees, variables=bronze.varinst,
        updated_at=updated_at, only=only, flag_reason=FLAG_REASON,
    )


def with_start_month(fact: DataFrame) -> DataFrame:
    """Add the fact's partition: 'yyyyMM' of the opening date, 'none' without one."""
    return fact.withColumn(FACT_PARTITION, F.coalesce(year_month("task_start_date"), F.lit("none")))


# The index of event months: which opening months hold tasks claimed or ended in a month. One row per pair of calendar
# months and write, never removed, so it may name too many months but not too few.
EVENT_MONTHS_DDL = f"run string, event_month string, {FACT_PARTITION} string"
OPENED, CLOSED = "opened", "closed"


def write_fact(fact: DataFrame, path: str) -> None:
    """Partitioned by the month of the opening date; the index of event months is written with it."""
    spark, run = fact.sparkSession, uuid.uuid4().hex
    opened = spark.createDataFrame([(run, OPENED, None)], EVENT_MONTHS_DDL)
    append_rows(opened.coalesce(1), event_months_path(path))
    overwrite_periods(with_start_month(fact), path, [FACT_PARTITION])
    pairs = event_months(read_fact(spark, path)).select(F.lit(run).alias("run"), "event_month", FACT_PARTITION)
    closed = spark.createDataFrame([(run, CLOSED, None)], EVENT_MONTHS_DDL)
    append_rows(pairs.unionByName(closed).coalesce(1), event_months_path(path))


def event_months_path(fact_path: str) -> str:
    return fact_path.rstrip("/") + "_event_months"


def event_months(fact: DataFrame) -> DataFrame:
    """Distinct (event_month, start_month) of the claim and end dates of fact rows."""
    days = F.explode(F.array("task_claim_date", "task_end_date")).alias("day")
    return fact.select(days, FACT_PARTITION).where("day is not null").select(
        year_month("day").alias("event_month"), FACT_PARTITION).distinct()


def opening_months_of(spark: SparkSession, fact_path: str, months: Sequence[str]) -> list[str] | None:
    """Opening months that may hold tasks with an event in ``months``; None if the index does not say (a table without one,
    or a write of the whole fact that broke off)."""
    path = event_months_path(fact_path)
    if not path_exists(spark, path):
        return None
    index = spark.read.schema(EVENT_MONTHS_DDL).parquet(path)
    rows = index.where(F.col("event_month").isin(OPENED, CLOSED, *months)).distinct().collect()
    begun, ended = ({row["run"] for row in rows if row["event_month"] == state} for state in (OPENED, CLOSED))
    return None if begun - ended else sorted({row[FACT_PARTITION] for row in rows if row[FACT_PARTITION] is not None})


def period_month(period_type: Column, day: Column) -> Column:
    """'yyyyMM' of a period's first day, from any day in it."""
    monday = F.trunc(day, "week")
    return year_month(F.when(period_type == "Week", monday).otherwise(day))


def write_summary(summary: DataFrame, path: str) -> None:
    """Partitioned by grain and month of the period: a few files per month, and the unit an update replaces."""
    months = period_month(F.col("period_type"), F.col("snapshot_date"))
    overwrite_periods(summary.withColumn("period_month", months), path, SUMMARY_PARTITIONS)


def calendar_months(months: DataFrame) -> list[str]:
    """The distinct 'yyyyMM' values of a column: as many as the calendar has months, whatever the rows."""
    return sorted(row[0] for row in months.distinct().collect())


def in_months(fact: DataFrame, months: list[str]) -> DataFrame:
    """Read only these months' folders; a list of literals prunes partitions at planning time."""
    return fact.where(F.col(FACT_PARTITION).isin(months))


@dataclass(frozen=True)
class Merge:
    """What a change set does to the fact: dates of both versions of the tasks, the new rows of the months, and these months."""

    versions: DataFrame
    rows: DataFrame
    months: list[str]


def merge_fact(path: str, new: DataFrame, version_cols: Sequence[str], stage: Callable[[DataFrame], DataFrame],
               homes: Sequence[str] | None = None) -> Merge:
    """Decide, per task, between the stored and the changed version; the newer one wins, the change on a tie.

    ``new`` has one row per task, staged, with its month. Months are those the changed tasks are in now and those they may
    be stored in: ``homes`` if given, else found by reading the task key of all months. Who wins is decided on keys, versions
    and dates, so whole rows move once, and stored ones that are replaced not at all. Nothing is written to the fact table;
    ``stage`` holds the rows until they are.
    """
    stored = read_fact(new.sparkSession, path)
    if homes is None:
        found = stored.select("task_id", FACT_PARTITION).join(new.select("task_id"), "task_id", "left_semi")
        months = calendar_months(new.select(FACT_PARTITION).union(found.select(FACT_PARTITION)))
    else:
        months = sorted({*calendar_months(new.select(FACT_PARTITION)), *homes})
    touched = in_months(stored, months)
    known = [c for c in version_cols if c in stored.columns]
    narrow = touched.select("task_id", *known, *TASK_DATES).withColumns(
        {c: F.lit(None).cast(new.schema[c].dataType) for c in version_cols if c not in known})
    offered = new.select("task_id", *[F.col(c).alias(f"_new_{c}") for c in version_cols])
    stays = F.lit(False)
    for c in reversed(version_cols):
        held, comes = F.col(c), F.col(f"_new_{c}")
        stays = (held.isNotNull() & (comes.isNull() | (held > comes))) | (held.eqNullSafe(comes) & stays)
    old = stage(narrow.join(offered, "task_id").select("task_id", *TASK_DATES, stays.alias("_stays")))
    versions = old.select(*TASK_DATES).unionByName(new.select(*TASK_DATES))
    winners, kept = new, touched.join(new.select("task_id"), "task_id", "left_anti")
    beaten = old.where("_stays").select("task_id")
    if not beaten.isEmpty():
        winners = stage(new.join(beaten, "task_id", "left_anti"))
        kept = kept.unionByName(latest_by_key(touched.join(beaten, "task_id", "left_semi"), ["task_id"], known))
    return Merge(versions, stage(kept).unionByName(winners, True), months)


def write_merge(merge: Merge, path: str) -> None:
    overwrite_periods(merge.rows, path, [FACT_PARTITION])
    filled = set(calendar_months(merge.rows.select(FACT_PARTITION)))
    emptied = [(month,) for month in merge.months if month not in filled]
    if emptied:
        remove_partitions(merge.rows.sparkSession.createDataFrame(emptied, f"{FACT_PARTITION} string"), path, [FACT_PARTITION])


def journal_path(summary_path: str) -> str:
    return summary_path.rstrip("/") + "_journal"


def open_partitions(spark: SparkSession, summary_path: str) -> DataFrame | None:
    """(run, period_type, period_month) of runs that wrote the fact, or were about to, and did not finish the summary."""
    path = journal_path(summary_path)
    if not path_exists(spark, path):
        return None
    journal = spark.read.parquet(path)
    done = journal.where("period_type is null").select("run").distinct()
    return journal.where("period_type is not null").join(done, "run", "left_anti")


def affected_partitions(changed: DataFrame, cutoff: str | dt.date) -> DataFrame:
    """Summary partitions that hold a period the changed tasks reach: at most three rows per calendar month."""
    periods = affected_periods(changed, cutoff)
    return periods.select("period_type", year_month("period_start").alias("period_month")).distinct()


def _needed_tasks(fact: DataFrame, partitions: DataFrame, cutoff: str | dt.date, fact_path: str | None = None) -> DataFrame:
    """Tasks those partitions are computed from: openings of the months and a week around, and earlier event days.

    With ``fact_path`` the months to open for event days come from the index of event months.
    """
    first = F.to_date(F.concat("period_month", F.lit("01")), "yyyyMMdd")
    earliest, latest = F.date_sub(first, BACKLOG_DAYS - 1), F.date_add(F.last_day(first), 6)
    opening_months = calendar_months(partitions.select(
        F.explode(F.array(year_month(earliest), "period_month", year_month(latest)))
    ))
    opened = F.col(FACT_PARTITION).isin(opening_months)

    first_current = F.date_format(F.lit(cutoff).cast("date"), "yyyyMM")
    of_events = calendar_months(partitions.where(
        (F.col("period_type") == "Day") & (F.col("period_month") < first_current)
    ).select("period_month"))
    if not of_events:
        return fact.where(opened)
    acted = [F.coalesce(year_month(c).isin(of_events), F.lit(False)) for c in ("task_claim_date", "task_end_date")]
    indexed = None if fact_path is None else opening_months_of(fact.sparkSession, fact_path, of_events)
    if indexed is not None:
        fact = in_months(fact, sorted({*opening_months, *indexed}))
    return fact.where(opened | acted[0] | acted[1])


def retire_months(spark: SparkSession, fact_path: str, as_of: dt.date, years: int = 1) -> list[str]:
    """Retention by months: empty the fact's month folders that lie wholly ``years`` or more before ``as_of``.

    Only folder names are read and no kept row is written again. Returns the months emptied.
    """
    bound = f"{as_of.year - years}{as_of.month:02d}"
    months = [m for m in calendar_months(read_fact(spark, fact_path).select(FACT_PARTITION)) if m < bound]
    if months:
        remove_partitions(spark.createDataFrame([(m,) for m in months], f"{FACT_PARTITION} string"), fact_path, [FACT_PARTITION])
    return months


def summary_of(fact: DataFrame, cutoff: str | dt.date, as_of: DateLike) -> DataFrame:
    return task_summary(fact, cutoff, as_of)


def refresh_summary(fact: DataFrame, partitions: DataFrame, cutoff: str | dt.date, as_of: DateLike,
                    fact_path: str | None = None) -> DataFrame:
    """Recompute exactly the given summary partitions."""
    recomputed = summary_of(_needed_tasks(fact, partitions, cutoff, fact_path), cutoff, as_of)
    months = period_month(F.col("period_type"), F.col("snapshot_date"))
    return recomputed.withColumn("period_month", months).join(partitions, [*SUMMARY_PARTITIONS], "left_semi")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(FACT_PARTITION, F.col(FACT_PARTITION).cast("string"))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("period_month", F.col("period_month").cast("string"))


def merge_changes(spark: SparkSession, changes: DataFrame, fact_path: str, summary_path: str, cutoff: str | dt.date,
                  version_cols: Sequence[str] = ("_mview_update_time",), homes: Sequence[str] | None = None) -> int:
    """Put changed tasks into the fact table; returns their number.

    Of several versions of a task in the changes the newest counts, and an older change than the stored row changes
    nothing (by those of ``version_cols`` that the changes have). ``homes`` as in ``merge_fact``. The summary partitions to
    recompute are written to the journal before the fact is touched; ``refresh_open`` works them off. The first call creates
    the fact table.
    """
    version_cols = [c for c in version_cols if c in changes.columns]
    with stages(spark) as stage:
        new = stage(with_start_month(latest_by_key(changes, ["task_id"], version_cols)))
        exists = path_exists(spark, fact_path)
        merge = merge_fact(fact_path, new, version_cols, stage, homes) if exists else None
        journal = affected_partitions(merge.versions if exists else new, cutoff)
        entries = journal.select(F.lit(uuid.uuid4().hex).alias("run"), *SUMMARY_PARTITIONS)
        append_rows(entries.coalesce(1), journal_path(summary_path))
        if exists:
            # In front of the rows: the index may name too many months, not too few.
            if path_exists(spark, event_months_path(fact_path)):
                pairs = event_months(new).select(F.lit(None).cast("string").alias("run"), "event_month", FACT_PARTITION)
                append_rows(pairs.coalesce(1), event_months_path(fact_path))
            write_merge(merge, fact_path)
        else:
            write_fact(new.drop(FACT_PARTITION), fact_path)
        return new.count()


def merge_tasks(bronze: Bronze, only: DataFrame, fact_path: str, summary_path: str, cutoff: str | dt.date, updated_at,
                levels: DataFrame | None = None) -> int:
    """Build the tasks ``only`` (staged keys) from bronze and put them into the fact table; returns their number.

    The task log is read once, for all versions of these tasks. Each stored row came from one of them, so their opening
    months are the only ones the tasks can be stored in, and no other month of the fact is read. The log must hold all
    versions a stored row was ever built from.
    """
    spark = only.sparkSession
    with stages(spark) as stage:
        versions = stage(bronze.taskinst.join(only, list(TASK_KEYS), "left_semi"))
        opened = versions.select(F.to_date("START_TIME_").alias("task_start_date"))
        homes = calendar_months(with_start_month(opened).select(FACT_PARTITION))
        rows = task_fact(replace(bronze, taskinst=versions), updated_at, levels=levels, only=only)
        return merge_changes(spark, rows, fact_path, summary_path, cutoff, homes=homes)


def refresh_open(spark: SparkSession, fact_path: str, summary_path: str, cutoff: str | dt.date, as_of: DateLike) -> int:
    """Recompute the summary partitions of all runs that have not finished, once each; returns the number of runs.

    A partition that no longer has any row is emptied, not left with its old numbers. Stored rollups are renewed for the
    same months before the runs count as finished. What is open is a short list: per run
    three partitions for each calendar month it reached.
    """
    found = open_partitions(spark, summary_path)
    entries = [] if found is None else found.distinct().collect()
    if not entries:
        return 0
    shape = ", ".join(f"{c} string" for c in SUMMARY_PARTITIONS)
    wanted = sorted({tuple(row[c] for c in SUMMARY_PARTITIONS) for row in entries})
    runs = sorted({row["run"] for row in entries})
    with stages(spark) as stage:
        partitions = spark.createDataFrame(wanted, shape)
        rows = stage(refresh_summary(read_fact(spark, fact_path), partitions, cutoff, as_of, fact_path))
        write_summary(rows, summary_path)
        filled = {tuple(row) for row in rows.select(*SUMMARY_PARTITIONS).distinct().collect()}
        emptied = [partition for partition in wanted if partition not in filled]
        if emptied:
            remove_partitions(spark.createDataFrame(emptied, shape), summary_path, SUMMARY_PARTITIONS)
        if path_exists(spark, summary_path):
            rollup_store.refresh_rollups(read_summary(spark, summary_path), rollup_store.rollup_path(summary_path),
                                         [month for _, month in wanted])
        finished = spark.createDataFrame([(run, None, None) for run in runs], "run string, " + shape)
        append_rows(finished.coalesce(1), journal_path(summary_path))
    return len(runs)


def apply_changes(spark: SparkSession, changes: DataFrame, fact_path: str, summary_path: str,
                  cutoff: str | dt.date, as_of: DateLike, version_cols: Sequence[str] = ("_mview_update_time",)) -> None:
    """Put changed tasks into the fact table and bring the summary table up to date.

    A run after a failure between the two recomputes what the failed one left open, too.
    """
    merge_changes(spark, changes, fact_path, summary_path, cutoff, version_cols)
    refresh_open(spark, fact_path, summary_path, cutoff, as_of)


def full_build(bronze: Bronze, fact_path: str, summary_path: str, cutoff: str | dt.date, as_of, updated_at) -> None:
    spark = bronze.taskinst.sparkSession
    write_fact(task_fact(bronze, updated_at), fact_path)
    write_summary(summary_of(read_fact(spark, fact_path), cutoff, as_of), summary_path)


def incremental_build(bronze: Bronze, fact_path: str, summary_path: str, lo, hi, cutoff: str | dt.date, as_of,
                      updated_at) -> None:
    """Rebuild tasks active in ``[lo, hi)`` and every summary period they reach."""
    spark = bronze.taskinst.sparkSession
    with stages(spark) as stage:
        merge_tasks(bronze, stage(active_tasks(bronze, lo, hi)), fact_path, summary_path, cutoff, updated_at)
    refresh_open(spark, fact_path, summary_path, cutoff, as_of)
