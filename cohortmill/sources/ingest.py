"""Lineage, watermarks and windowed or full loads of declared tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions.dates import year_month
from cohortmill.operators.filters import within
from cohortmill.operators.versions import latest_by_key
from cohortmill.sources.tables import append_rows, replace_snapshot

DEFAULT_HISTORY_START = "2025-01-01"

WATERMARK_DDL = (
    "table_name string, last_sync_time timestamp_ntz, sync_time timestamp_ntz, row_count bigint, duration_ms double, "
    "min_data_time timestamp_ntz, max_data_time timestamp_ntz"
)


def _timestamp(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def with_lineage(df: DataFrame, batch_id: str, extracted_at, version: int = 1) -> DataFrame:
    """Add which batch brought a row, when, and its version."""
    return df.withColumns({
        "_batch_id": F.lit(batch_id),
        "_extracted_at": _timestamp(extracted_at),
        "_sync_version": F.lit(version).cast("bigint"),
    })


def in_window(df: DataFrame, time_col: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= time < hi``; the bounds are literals, so files outside them are skipped."""
    return df.where(within(time_col, _timestamp(lo), _timestamp(hi)))


def with_month_partition(df: DataFrame, time_col: str, name: str = "ym") -> DataFrame:
    """Add the 'yyyyMM' partition column."""
    return df.withColumn(name, year_month(time_col))


def ingest_window(df: DataFrame, path: str, time_col: str, lo, hi, extracted_at) -> None:
    """Append one batch to a month-partitioned bronze table."""
    batch = with_lineage(in_window(df, time_col, lo, hi), f"{lo}_{hi}", extracted_at)
    append_rows(with_month_partition(batch, time_col), path, ["ym"])


def ingest_batches_of(df: DataFrame, path: str, time_col: str, lo: str, hi: str, step_days: int, extracted_at) -> dict:
    """Append ``[lo, hi)`` in one scan, each row marked with the batch of ``step_days`` it belongs to.

    The batch comes from arithmetic on the time, so their number costs nothing. Rows, first and last time are observed
    while the rows are written and returned as ``rows``, ``first`` and ``last``.
    """
    start, stop = _timestamp(lo), _timestamp(hi)
    number = F.floor(F.date_diff(F.to_date(time_col), F.to_date(start)) / step_days).cast("int")
    opened = F.greatest(F.date_add(F.to_date(start), number * step_days).cast("timestamp_ntz"), start)
    closed = F.least(F.date_add(F.to_date(start), (number + 1) * step_days).cast("timestamp_ntz"), stop)
    batch = with_lineage(in_window(df, time_col, lo, hi), "", extracted_at).withColumn(
        "_batch_id", F.concat(opened.cast("string"), F.lit("_"), closed.cast("string")))
    seen = Observation()
    time = F.col(time_col)
    batch = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.min(time.cast("string")).alias("first"),
                          F.max(time.cast("string")).alias("last"))
    # Few files per month, and a month too large for one task is split.
    append_rows(with_month_partition(batch, time_col).hint("rebalance", "ym"), path, ["ym"])
    return seen.get


def ingest_full(df: DataFrame, root: str, batch_id: str, extracted_at, keep: int | None = None) -> int:
    """Replace a full table; an empty load is refused. ``keep`` as in ``replace_snapshot``."""
    return replace_snapshot(with_lineage(df, batch_id, extracted_at), root, keep=keep)


def watermark_row(df: DataFrame, table: str, time_col: str, boundary, now, duration_ms: float = 0.0) -> DataFrame:
    """The watermark of a table after a load: boundary, run time, rows, duration, data span."""
    return df.agg(
        F.lit(table).alias("table_name"),
        _timestamp(boundary).alias("last_sync_time"),
        _timestamp(now).alias("sync_time"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(duration_ms).cast("double").alias("duration_ms"),
        F.min(time_col).cast("timestamp_ntz").alias("min_data_time"),
        F.max(time_col).cast("timestamp_ntz").alias("max_data_time"),
    )


def update_watermark(df: DataFrame, path: str, table: str, time_col: str, boundary, now, duration_ms: float = 0.0) -> None:
    append_rows(watermark_row(df, table, time_col, boundary, now, duration_ms), path)


def append_watermarks(spark: SparkSession, path: str, loads: list[tuple]) -> None:
    """Watermarks of finished loads whose figures were observed while they were written.

    A load is (table, rows, duration_ms, boundary, time of the run, first and last data time), times as text or None.
    """
    times = ("last_sync_time", "sync_time", "min_data_time", "max_data_time")
    marks = spark.createDataFrame(
        loads, "table_name string, row_count bigint, duration_ms double, " + ", ".join(f"{c} string" for c in times))
    names = [part.split()[0] for part in WATERMARK_DDL.split(", ")]
    typed = marks.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    append_rows(typed.select(*names).coalesce(1), path)


def latest_watermarks(watermarks: DataFrame) -> DataFrame:
    return latest_by_key(watermarks, ["table_name"], ["sync_time"])


def resume_point(watermarks: DataFrame, table: str, history_start: str | dt.date | None = None) -> DataFrame:
    """One cell: where the next load starts - data reached, else last boundary, else the history floor."""
    floor = _timestamp(str(history_start or DEFAULT_HISTORY_START))
    return (
        latest_watermarks(watermarks.where(F.col("table_name") == table))
        .agg(F.coalesce(F.max("max_data_time"), F.max("last_sync_time"), floor).alias("resume_at"))
    )
