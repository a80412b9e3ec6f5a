"""Incremental runs: windows, checkpoints, catch-up bounds and the periods late data touches.

Windows are half-open. A run appends to the checkpoint table; the newest row per phase and window counts.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateLike, as_date, month_key, period_start, week_key
from cohortmill.operators.cohort import BACKLOG_DAYS
from cohortmill.operators.versions import latest_by_key
from cohortmill.sources.tables import append_rows

CHECKPOINT_KEYS = ("phase", "window_start", "window_end")
SUCCESS, FAILED = "SUCCESS", "FAILED"

CHECKPOINT_DDL = (
    "phase string, window_start timestamp_ntz, window_end timestamp_ntz, status string, error_msg string, "
    "duration_ms double, result_rows bigint, result_bytes bigint, update_time timestamp_ntz"
)

# Phases in the order they run. "facts" holds variables, facts and exclusion, which are one query here; "summary" holds
# milestone, backlog, completion and summary, which are one aggregation.
PHASES = ("facts", "summary")


def _steps(bounds: DataFrame, start: Column, stop: Column, step: str) -> DataFrame:
    """Consecutive [start, next) windows up to ``stop``; the last one is cut short."""
    interval = F.expr(f"INTERVAL {step}")
    starts = bounds.select(start.alias("_start"), stop.alias("_stop")).where("_start < _stop").select(
        F.explode(F.sequence(F.col("_start"), F.col("_stop"), interval)).alias("window_start"), "_stop"
    ).where(F.col("window_start") < F.col("_stop"))
    return starts.select(
        "window_start", F.least(F.col("window_start") + interval, F.col("_stop")).alias("window_end")
    )


def etl_windows(bounds: DataFrame, start: str = "start_date", end: str = "end_date", step_days: int = 10) -> DataFrame:
    """Windows of ``step_days`` covering the inclusive dates of a one-row ``bounds``."""
    return _steps(
        bounds, F.col(start).cast("timestamp_ntz"), F.date_add(F.col(end), 1).cast("timestamp_ntz"),
        f"'{int(step_days)}' DAY",
    )


def ingest_batches(spark: SparkSession, start: str, end: str, step_days: int = 7, step_hours: int = 0) -> DataFrame:
    """Half-open ingest batches; an ``end`` given as a date includes that whole day."""
    stop = F.lit(end).cast("timestamp_ntz")
    if len(end) == 10:
        stop = stop + F.expr("INTERVAL '1' DAY")
    step = f"'{int(step_hours)}' HOUR" if step_hours > 0 else f"'{int(step_days)}' DAY"
    return _steps(spark.range(1), F.lit(start).cast("timestamp_ntz"), stop, step)


def latest_checkpoints(checkpoints: DataFrame) -> DataFrame:
    return latest_by_key(checkpoints, CHECKPOINT_KEYS, ["update_time"])


def mask_secrets(text: str) -> str:
    """The text with the values of passwords, keys and tokens hidden, as settings or inside addresses."""
    text = re.sub(r"(?i)\b(password|passwd|pwd|secret|token|access_?key)(\s*[=:]\s*)(\"[^\"]*\"|'[^']*'|[^\s;,&)]+)", r"\1\2***", text)
    return re.sub(r"(://[^\s:/@]+:)[^\s@/]+@", r"\1***@", text)


def checkpoint_row(spark: SparkSession, phase: str, window: tuple[dt.datetime, dt.datetime], status: str,
                   now: dt.datetime, duration_ms: float = 0.0, rows: int = 0, error: str = "") -> DataFrame:
    """One checkpoint to append after a phase ran."""
    return spark.createDataFrame(
        [(phase, *window, status, mask_secrets(error), duration_ms, rows, 0, now)], CHECKPOINT_DDL
    )


def run_phase(spark: SparkSession, log_path: str, phase: str, window: tuple[dt.datetime, dt.datetime],
              action: Callable[[], int], now: Callable[[], dt.datetime]) -> int:
    """Run one phase for one window and append its checkpoint: rows and duration, or the error, which is raised on."""
    began = now()

    def record(status: str, rows: int = 0, error: str = "") -> None:
        ended = now()
        duration = (ended - began).total_seconds() * 1000
        append_rows(checkpoint_row(spark, phase, window, status, ended, duration, rows, error).coalesce(1), log_path)

    try:
        rows = action()
    except Exception as failure:
        record(FAILED, error=str(failure))
        raise
    record(SUCCESS, rows)
    return rows


def pending_windows(windows: DataFrame, checkpoints: DataFrame, phase: str, activity_dates: DataFrame) -> DataFrame:
    """Windows of a phase that have input and no successful checkpoint.

    ``activity_dates`` (column ``day``) are the dates of the phase's own input; windows are matched to them day by
    day, an equality on calendar dates. A window without input is not pending; a later run looks at it again.
    """
    done = (
        latest_checkpoints(checkpoints.where(F.col("phase") == phase)).where(F.col("status") == SUCCESS)
        .select("window_start", "window_end")
    )
    open_windows = windows.join(done, ["window_start", "window_end"], "left_anti")
    last_day = F.to_date(F.col("window_end") - F.expr("INTERVAL '1' SECOND"))
    days = open_windows.withColumn(
        "day", F.explode(F.sequence(F.to_date("window_start"), last_day, F.expr("INTERVAL '1' DAY")))
    )
    return (
        days.join(activity_dates.select("day").distinct(), "day", "left_semi")
        .select("window_start", "window_end").distinct()
    )


def catchup_range(
    watermarks: DataFrame, checkpoints: DataFrame, *, as_of: DateLike, last_phase: str = PHASES[-1],
    driving_table: str = "bpm_act_hi_taskinst",
    data_tables: tuple[str, ...] = ("bpm_act_hi_taskinst", "bpm_act_hi_varinst"),
) -> DataFrame:
    """One row: the dates a catch-up run must cover.

    End: last sync of the driving table, else ``as_of``. Start: one day before the earlier of the last successful
    checkpoint and the data time both tables have reached; 14 days before the end when nothing succeeded yet.
    """
    name = F.col("table_name")
    marks = watermarks.agg(
        F.max(F.when(name == driving_table, F.col("last_sync_time"))).alias("synced"),
        F.min(F.when(name.isin(*data_tables), F.col("max_data_time"))).alias("reached"),
    )
    done = (
        latest_checkpoints(checkpoints.where(F.col("phase") == last_phase))
        .where(F.col("status") == SUCCESS)
        .agg(F.max("window_end").alias("finished"))
    )
    end = F.coalesce(F.to_date("synced"), as_date(as_of))
    anchor = F.least("finished", "reached")
    start = F.when(F.col("finished").isNotNull(), F.date_sub(F.to_date(anchor), 1)).otherwise(F.date_sub(end, 14))
    return (
        marks.withColumn("finished", done.scalar())
        .select(start.alias("start_date"), end.alias("end_date"))
    )


def touched_dates(changes: DataFrame) -> DataFrame:
    """Distinct (day, opened) of changed tasks: opening dates, and all event dates; pass old and new versions."""
    dates = [("task_start_date", True), ("task_start_date", False), ("task_claim_date", False), ("task_end_date", False)]
    entries = [F.struct(F.col(c).alias("day"), F.lit(opened).alias("opened")) for c, opened in dates]
    return changes.select(F.inline(F.array(*entries))).where(F.col("day").isNotNull()).distinct()


def affected_periods(changes: DataFrame, cutoff: DateLike | None = None, days: int = BACKLOG_DAYS) -> DataFrame:
    """Summary periods whose rows may differ after these tasks changed: (period_type, period_key, period_start).

    An opening date reaches the Day rows of the following backlog days, and the ISO weeks and months of its first
    and last backlog day. Claim and end dates matter only to event days before the cutoff. The result has at most a
    few rows per calendar day.
    """
    dates = touched_dates(changes)
    opened = dates.where("opened").select("day")
    last = F.date_add("day", days - 1)
    day_rows = opened.select(
        F.explode(F.sequence(F.col("day"), last, F.expr("INTERVAL '1' DAY"))).alias("period_start")
    )
    events = dates.where(~F.col("opened"))
    if cutoff is not None:
        events = events.where(F.col("day") < as_date(cutoff))
    day_rows = day_rows.unionByName(events.select(F.col("day").alias("period_start")))

    def both_ends(grain: str) -> DataFrame:
        return opened.select(
            F.explode(F.array(period_start(grain, "day"), period_start(grain, last))).alias("period_start")
        )

    parts = (
        day_rows.select(F.lit("Day").alias("period_type"), F.col("period_start").cast("string").alias("period_key"), "period_start"),
        both_ends("Week").select(F.lit("Week").alias("period_type"), week_key("period_start").alias("period_key"), "period_start"),
        both_ends("Month").select(F.lit("Month").alias("period_type"), month_key("period_start").alias("period_key"), "period_start"),
    )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.distinct()


def run_status(watermarks: DataFrame, checkpoints: DataFrame, tables: dict[str, DataFrame],
               last: int = 20) -> dict[str, DataFrame]:
    """Three frames: newest watermark per table, the last checkpoints, and row counts."""
    from cohortmill.plans.recon import layer_counts

    return {
        "watermarks": latest_by_key(watermarks, ["table_name"], ["sync_time"]).orderBy("table_name"),
        "checkpoints": latest_checkpoints(checkpoints).select(
            *CHECKPOINT_KEYS, "status", F.round(F.col("duration_ms") / 1000, 2).alias("duration_sec"),
            readable_size(F.col("result_bytes")).alias("size"), F.col("result_rows").alias("rows"), "update_time",
        ).orderBy(F.col("update_time").desc(), *CHECKPOINT_KEYS).limit(last),
        "row_counts": layer_counts(tables),
    }


def readable_size(size: Column) -> Column:
    """'1.50 KiB', '2.00 GiB'."""
    def text(scale: int, unit: str) -> Column:
        number = F.call_function("format_number", size / F.lit(float(scale)), F.lit("0.00"))
        return F.concat(number, F.lit(f" {unit}"))

    shown = text(1, "B")
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB", "PiB"), start=1):
        shown = F.when(size >= 1024 ** power, text(1024 ** power, unit)).otherwise(shown)
    return shown


def table_freshness(tables: DataFrame, as_of, stale_hours: int = 24) -> DataFrame:
    """Status per table from strategy, current rows and last success: an empty full table, then stale, then ok."""
    now = as_of.scalar() if isinstance(as_of, DataFrame) else F.lit(as_of).cast("timestamp_ntz")
    hours = F.floor(F.timestamp_diff("SECOND", F.col("last_success"), now) / 3600).cast("bigint")
    return tables.withColumn("hours_since_success", hours).withColumn(
        "status",
        F.when((F.col("strategy") == "full") & (F.col("current_rows") == 0), F.lit("empty"))
        .when(F.col("last_success").isNull() | (F.col("hours_since_success") >= stale_hours), F.lit("stale"))
        .otherwise(F.lit("ok")),
    )
