"""Aggregations over finished KPI rows, users and event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.rates import ratio_or_zero
from cohortmill.functions.values import first_nonblank
from cohortmill.operators.versions import newest_value


def distinct_count(df: DataFrame, by: Sequence[str], keys: Sequence[str], name: str = "distinct_keys") -> DataFrame:
    """Exact distinct key tuples per group, in two grouping steps so that a hot group is spread over its keys."""
    return df.select(*by, *keys).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def data_span(df: DataFrame, time_col: str) -> DataFrame:
    """Smallest and largest time and the row count; NULL bounds for no rows."""
    return df.agg(
        F.min(time_col).alias("min_time"), F.max(time_col).alias("max_time"), F.count(F.lit(1)).alias("row_count")
    )


def latest_then_sum(df: DataFrame, by: Sequence[str], within: Sequence[str], order_col: str,
                    sums: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """Sum some columns over all rows, and others only over each inner group's newest row."""
    inner = df.groupBy(*by, *within).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[newest_value(F.col(c), F.col(order_col)).alias(c) for c in latest],
    )
    return inner.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (*sums, *latest)])


def rollup_table(summary: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sums of Day rows over the chosen dimensions; save the result as a table to serve it."""
    return (
        summary.where(F.col("period_type") == "Day")
        .groupBy("snapshot_date", *by).agg(*[F.sum(m).alias(m) for m in measures])
    )


def with_label_dimensions(df: DataFrame, unknown: str = "UNKNOWN") -> DataFrame:
    """'' becomes a readable label in region, plant and factory, plus the location path of the three."""
    levels = {c: first_nonblank(F.col(c), default=unknown) for c in ("region", "plant", "factory")}
    path = F.concat_ws("-", *levels.values())
    return df.withColumns({**levels, "line": first_nonblank(F.col("line")), "location_path": path})


def composite_rates(df: DataFrame) -> DataFrame:
    """Composite counts and zero-safe percents of a row with total/todo/doing/done."""
    total, todo, doing, done = (F.col(f"{c}_qty") for c in ("total", "todo", "doing", "done"))
    return df.withColumns({
        "todo_doing_qty": todo + doing,
        "doing_done_qty": doing + done,
        "todo_rate": ratio_or_zero(todo, total),
        "doing_rate": ratio_or_zero(doing, total),
        "done_rate": ratio_or_zero(done, total),
        "completion_rate": ratio_or_zero(done, total),
        "execution_rate": ratio_or_zero(doing + done, total),
    })


def user_utilization(fact: DataFrame) -> DataFrame:
    """Users and tasks per opening date, vx_type and plant.

    Grouped by user first: three distinct counts become plain counts, without multiplying the rows.
    """
    open_task = F.col("status_daily").isin("TODO", "DOING")
    done_task = F.col("status_daily") == "DONE"
    assigned = fact.where((F.col("is_excluded") == 0) & (F.col("assignee_code") != ""))
    per_user = assigned.groupBy(
        F.col("task_start_date").alias("snapshot_date"), "vx_type", "plant", "assignee_code"
    ).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(open_task).alias("open_tasks"),
        F.count_if(done_task).alias("done_tasks"),
    )
    users = per_user.groupBy("snapshot_date", "vx_type", "plant").agg(
        F.count(F.lit(1)).alias("active_users"),
        F.count_if(F.col("open_tasks") > 0).alias("working_users"),
        F.count_if(F.col("done_tasks") > 0).alias("completed_users"),
        F.sum("tasks").alias("total_tasks"),
        F.sum("done_tasks").alias("done_tasks"),
    )
    return users.withColumns({
        "utilization_rate": ratio_or_zero(F.col("working_users"), F.col("active_users")),
        "tasks_per_user": ratio_or_zero(F.col("total_tasks"), F.col("active_users"), 1.0),
    })


def events_per_period(log: DataFrame, time_col: str, unit: str, where: Column | None = None,
                      per: float | None = None) -> DataFrame:
    """Event counts per hour or minute; ``per`` divides the count (60 turns a minute's count into a rate)."""
    rows = log if where is None else log.where(where)
    counts = rows.groupBy(F.date_trunc(unit, time_col).alias("time")).agg(F.count(F.lit(1)).alias("events"))
    return counts if per is None else counts.withColumn("rate", F.col("events") / F.lit(per))


def recent_events(log: DataFrame, time_col: str, as_of, hours: int, where: Column | None = None) -> DataFrame:
    """How many matching events happened in the last ``hours``."""
    rows = log if where is None else log.where(where)
    until = as_of.scalar() if isinstance(as_of, DataFrame) else F.lit(as_of).cast("timestamp_ntz")
    since = until - F.expr(f"INTERVAL '{int(hours)}' HOUR")
    return rows.where(F.col(time_col) >= since).agg(F.count(F.lit(1)).alias("events"))
