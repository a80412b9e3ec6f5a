"""The daily run: load every declared table from where it stopped, then bring fact and summary up to date.

Tables of a store:

    <root>/<target>             bronze: snapshots of full tables, month folders of batch tables
    <root>/five_level           stored organisation levels, rebuilt after each load of the master data
    <root>/fact, <root>/summary and the summary's journal
    <root>/watermarks, <root>/checkpoints
    <root>/feed/<name>          hashes of the master data the fact was built from, and <root>/feed/versions: which versions

The clock is an argument, so a run can be repeated. One writer per store.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateLike
from cohortmill.plans import daily, feed
from cohortmill.plans.runs import (
    CHECKPOINT_DDL, PHASES, SUCCESS, catchup_range, etl_windows, latest_checkpoints, mask_secrets, pending_windows, run_phase,
)
from cohortmill.sources import ingest, tables
from cohortmill.sources.catalog import FULL, SOURCE_TABLES, TableSpec
from cohortmill.sources.readers import apply_select_list

Clock = Callable[[], dt.datetime]

# Bronze field -> declared table.
BRONZE_TABLES = {
    "taskinst": "taskinst", "varinst": "varinst", "procinst": "procinst", "procdef": "procdef",
    "employees": "hr_employee", "line_desc": "mdm_line_desc", "prod_area": "mdm_prod_area",
    "mfg_plant": "mdm_mfg_plant", "factory_area": "mdm_factory_area", "mfg_site": "mdm_mfg_site",
}
BATCH_LINEAGE = ", _batch_id string, _extracted_at timestamp_ntz, _sync_version bigint, ym string"
# Versions kept of a replaced table: the current one, and the one readers may still be at work on.
KEEP = 2
MASTER_DATA = ("line_desc", "prod_area", "mfg_plant", "factory_area", "mfg_site")


class SyncError(RuntimeError):
    """Tables that could not be loaded; the others were."""


@dataclass(frozen=True)
class Store:
    """The paths of one store of tables."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def bronze(self, spec: TableSpec) -> str:
        return self.path(spec.target)


def read_bronze_table(spark: SparkSession, store: Store, spec: TableSpec) -> DataFrame:
    """What was loaded of one table, with lineage; a batch table of which nothing came yet is empty."""
    path = store.bronze(spec)
    return tables.read_snapshot(spark, path) if spec.strategy == FULL else _read_log(spark, path, spec.ddl + BATCH_LINEAGE)


def read_bronze(spark: SparkSession, store: Store, specs: Mapping[str, TableSpec] = SOURCE_TABLES) -> daily.Bronze:
    return daily.Bronze(**{
        field: read_bronze_table(spark, store, specs[name]) for field, name in BRONZE_TABLES.items()
    })


def _read_log(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path) if tables.path_exists(spark, path) else spark.createDataFrame([], ddl)


def watermarks(spark: SparkSession, store: Store) -> DataFrame:
    return _read_log(spark, store.path("watermarks"), ingest.WATERMARK_DDL)


def checkpoints(spark: SparkSession, store: Store) -> DataFrame:
    return _read_log(spark, store.path("checkpoints"), CHECKPOINT_DDL)


def resume_points(spark: SparkSession, store: Store) -> dict[str, tuple[str, str]]:
    """Target -> (boundary of its last load, time to continue at): one row per declared table."""
    rows = ingest.latest_watermarks(watermarks(spark, store)).select(
        "table_name", F.col("last_sync_time").cast("string"), F.coalesce("max_data_time", "last_sync_time").cast("string"))
    return {name: (boundary, resume) for name, boundary, resume in rows.collect()}


def sync_table(spec: TableSpec, source: DataFrame, store: Store, lo: str, until: str, now: Clock) -> tuple:
    """Load one declared table up to ``until``; returns the row of its watermark.

    A full table is replaced, and an empty load refused. A batch table continues at ``lo``; rows at exactly that time
    come again and count once, since readers take the newest version.
    """
    began = now()
    typed = apply_select_list(source, spec)
    if spec.strategy == FULL:
        rows, first, last = ingest.ingest_full(typed, store.bronze(spec), f"full_{until}", str(began), KEEP), None, None
    else:
        seen = ingest.ingest_batches_of(typed, store.bronze(spec), spec.time_col, lo, until, spec.step_days, str(began))
        rows, first, last = seen["rows"], seen["first"], seen["last"]
    ended = now()
    return spec.target, rows, (ended - began).total_seconds() * 1000, until, str(ended), first, last


def sync_all(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], store: Store, until: str, now: Clock,
             specs: Mapping[str, TableSpec] = SOURCE_TABLES, parallel: int = 4) -> dict[str, int]:
    """Load all tables, ``parallel`` at a time; returns their rows.

    ``sources`` maps a declared table to a function that opens it, so a source that cannot be opened fails alone: the
    others are loaded, and the run ends with an error that names it. A table with a load up to ``until`` on record is
    not read. Watermarks are written together once the loads are done. After a load of master data, and only if all of
    it succeeded, the stored five-level table is replaced.
    """
    marks = resume_points(spark, store)
    due = {n: opened for n, opened in sources.items() if marks.get(specs[n].target, ("", ""))[0] < until}
    floor = ingest.DEFAULT_HISTORY_START

    def load(name: str) -> tuple:
        spec = specs[name]
        lo = marks[spec.target][1] if spec.target in marks else spec.history_start or floor
        return sync_table(spec, due[name](), store, lo, until, now)

    loaded, failed = {}, {}
    with ThreadPoolExecutor(parallel) as pool:
        for name, job in [(name, pool.submit(load, name)) for name in due]:
            try:
                loaded[name] = job.result()
            except Exception as error:
                failed[name] = mask_secrets(str(error))
    if loaded:
        ingest.append_watermarks(spark, store.path("watermarks"), list(loaded.values()))
    masters = [BRONZE_TABLES[field] for field in MASTER_DATA]
    if set(masters) & set(loaded) and not set(masters) & set(failed):
        levels = daily.five_level(read_bronze(spark, store, specs))
        tables.replace_snapshot(levels, store.path("five_level"), allow_empty=True, keep=KEEP)
    if failed:
        raise SyncError("; ".join(f"{name}: {text}" for name, text in sorted(failed.items())))
    return {name: loaded[name][1] if name in loaded else 0 for name in sources}


def _activity(bronze: daily.Bronze, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Days of ``[lo, hi)`` on which tasks were updated, or variables or processes came; other months are not opened."""
    logs = {"taskinst": "LAST_UPDATED_TIME_", "varinst": "CREATE_TIME_", "procinst": "START_TIME_"}
    days = [daily.in_load_months(getattr(bronze, log), column, lo, hi).select(F.to_date(column).alias("day"))
            for log, column in logs.items()]
    return days[0].union(days[1]).union(days[2]).distinct()


VERSIONS_DDL = "sequence bigint, name string, version string"
# Stored table -> the feeds that come from it.
FEEDS = {"procdef": ("definitions",), "hr_employee": ("people",), "five_level": ("lines", "plants")}


def open_feeds(spark: SparkSession, store: Store, specs: Mapping[str, TableSpec] = SOURCE_TABLES) -> dict[str, str]:
    """Stored tables, with their current version, that were replaced since the fact took them over."""
    paths = {name: store.bronze(specs[name]) if name in specs else store.path(name) for name in FEEDS}
    current = {name: tables.current_version(spark, path) for name, path in paths.items()}
    log = _read_log(spark, store.path("feed/versions"), VERSIONS_DDL)
    taken = {r["name"]: r["version"] for r in log.groupBy("name").agg(F.max_by("version", "sequence").alias("version")).collect()}
    return {name: version for name, version in current.items() if version is not None and taken.get(name) != version}


def take_over(spark: SparkSession, store: Store, states: Mapping[str, DataFrame], versions: Mapping[str, str]) -> None:
    """Record that the fact holds these versions: first the hashes, then the versions, so a failure in between repeats."""
    for name in versions:
        for part in FEEDS[name]:
            tables.replace_snapshot(states[part], store.path(f"feed/{part}"), allow_empty=True, keep=KEEP)
    log = _read_log(spark, store.path("feed/versions"), VERSIONS_DDL)
    following = (log.agg(F.max("sequence")).first()[0] or 0) + 1
    rows = spark.createDataFrame([(following, name, version) for name, version in versions.items()], VERSIONS_DDL)
    tables.append_rows(rows.coalesce(1), store.path("feed/versions"))


def apply_feed(spark: SparkSession, store: Store, bronze: daily.Bronze, levels: DataFrame, versions: Mapping[str, str], *,
               cutoff: str | dt.date, updated_at: str) -> int:
    """Rebuild the tasks that changed master data reaches; returns their number.

    The summary partitions are in the journal when it returns. A store that never recorded its master data compares with
    nothing, so all its tasks are built anew.
    """
    fact, summary = store.path("fact"), store.path("summary")
    with tables.stages(spark) as stage:
        now = feed.states(bronze, levels)
        parts = [part for name in versions for part in FEEDS[name]]
        states = {part: stage(now[part]) for part in parts}

        def before(part: str) -> DataFrame:
            root = store.path(f"feed/{part}")
            known = tables.current_version(spark, root) is not None
            return tables.read_snapshot(spark, root) if known else spark.createDataFrame([], feed.STATE_DDL[part])

        changed = {part: stage(feed.changed_keys(before(part), states[part], feed.KEYS[part])) for part in parts}
        changed = {part: keys for part, keys in changed.items() if not keys.isEmpty()}
        built = 0
        if changed:
            only = stage(feed.reached_tasks(changed, daily.read_fact(spark, fact), bronze.taskinst))
            built = daily.merge_tasks(bronze, only, fact, summary, cutoff, updated_at, levels)
        take_over(spark, store, states, versions)
    return built


def run_windows(spark: SparkSession, store: Store, windows: DataFrame, *, cutoff: str | dt.date, as_of: DateLike,
                updated_at: str, now: Clock, specs: Mapping[str, TableSpec] = SOURCE_TABLES) -> dict[str, int]:
    """Run both phases for the windows that have input and no successful checkpoint; returns windows run per phase.

    Master data that was replaced since the last run comes first and reaches all tasks it concerns, whatever their age.
    Facts are merged window by window. The summary is then refreshed once over what all of them reached, and a failure
    in between leaves the journal that the next run starts from. Windows are a short list of calendar ranges.
    """
    bronze = read_bronze(spark, store, specs)
    levels = tables.read_snapshot(spark, store.path("five_level"))
    fact, summary, log = store.path("fact"), store.path("summary"), store.path("checkpoints")

    def pending(phase: str, activity: DataFrame) -> list[tuple[dt.datetime, dt.datetime]]:
        found = pending_windows(windows, checkpoints(spark, store), phase, activity)
        return sorted((row["window_start"], row["window_end"]) for row in found.collect())

    def build(lo: dt.datetime, hi: dt.datetime, first: bool) -> int:
        with tables.stages(spark) as stage:
            if first:
                return daily.merge_changes(spark, daily.task_fact(bronze, updated_at, levels=levels), fact, summary, cutoff)
            only = stage(daily.changed_tasks(bronze, lo, hi))
            return daily.merge_tasks(bronze, only, fact, summary, cutoff, updated_at, levels)

    def refresh() -> int:
        return daily.refresh_open(spark, fact, summary, cutoff, as_of)

    facts, totals = PHASES
    bounds = windows.agg(F.min("window_start").alias("lo"), F.max("window_end").alias("hi")).first()
    todo = {phase: [] for phase in PHASES}
    if bounds["lo"] is not None:
        with tables.stages(spark) as stage:
            activity = stage(_activity(bronze, bounds["lo"], bounds["hi"]))
            todo = {phase: pending(phase, activity) for phase in PHASES}
    # A store's first build takes everything loaded so far, which covers the other windows of its run.
    first = checkpoints(spark, store).where((F.col("phase") == facts) & (F.col("status") == SUCCESS)).isEmpty()
    versions = open_feeds(spark, store, specs)
    if versions and not first:
        apply_feed(spark, store, bronze, levels, versions, cutoff=cutoff, updated_at=updated_at)
    for number, (lo, hi) in enumerate(todo[facts]):
        covered = first and number > 0
        run_phase(spark, log, facts, (lo, hi),
                  lambda lo=lo, hi=hi, covered=covered: 0 if covered else build(lo, hi, first), now)
    if versions and first and todo[facts]:
        with tables.stages(spark) as stage:
            states = {part: stage(state) for part, state in feed.states(bronze, levels).items()}
            take_over(spark, store, states, versions)
    for window in todo[totals]:
        run_phase(spark, log, totals, window, refresh, now)
    if not todo[totals]:
        # Master data may change tasks on days without any other input.
        refresh()
    return {phase: len(windows) for phase, windows in todo.items()}


def run_daily(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], store: Store, *, until: str,
              cutoff: str | dt.date, as_of: DateLike, updated_at: str, now: Clock, start: str | None = None,
              step_days: int = 10, specs: Mapping[str, TableSpec] = SOURCE_TABLES) -> dict[str, int]:
    """Load all tables up to ``until``, then run the windows of the catch-up range, or those from ``start`` on.

    Replaced master data reaches all tasks it concerns, by the change feed.
    """
    loaded = sync_all(spark, sources, store, until, now, specs)
    idle = {**{f"rows:{name}": rows for name, rows in loaded.items()}, **{phase: 0 for phase in PHASES}}
    last = latest_checkpoints(checkpoints(spark, store)).where((F.col("phase") == PHASES[-1]) & (F.col("status") == SUCCESS))
    finished = last.agg(F.max("window_end") >= F.lit(until).cast("timestamp_ntz")).first()[0]
    if finished and not any(loaded.values()) and not open_feeds(spark, store, specs):
        return idle
    if start is None:
        bounds = catchup_range(watermarks(spark, store), checkpoints(spark, store), as_of=as_of)
    else:
        bounds = spark.range(1).select(
            F.lit(start).cast("date").alias("start_date"), F.lit(until).cast("date").alias("end_date"))
    # The last window ends where the load ended: what comes later that day belongs to a window of a later run.
    end = F.least("window_end", F.lit(until).cast("timestamp_ntz"))
    windows = etl_windows(bounds, step_days=step_days).withColumn("window_end", end).where("window_start < window_end")
    done = run_windows(spark, store, windows, cutoff=cutoff, as_of=as_of, updated_at=updated_at, now=now, specs=specs)
    return {**idle, **done}
