"""Period reports, drill-downs and detail reads over the summary and the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.functions.dates import (
    DateLike, as_date, month_key, month_name, week_key, week_name,
)
from cohortmill.functions.rates import capped_floor_rate, floor_rate, percent_text, rounded_rate
from cohortmill.functions.status import cohort_status
from cohortmill.operators.filters import TASK_DATES, filter_dims, status_on_day
from cohortmill.operators.rollups import composite_rates, latest_then_sum

QTY = ("total_qty", "todo_qty", "doing_qty", "doing_done_qty", "done_qty", "acc_qty", "acc_total_qty")

# Report lines in display order, and the count each one shows.
STATUS_LINES = (
    ("1. Total Task", "total_qty"), ("2. Todo", "todo_qty"), ("3. Doing", "doing_qty"),
    ("4. Done", "done_qty"), ("5. Doing+Done", "doing_done_qty"), ("6. Todo+Doing(Acc)", "acc_qty"),
)

DETAIL_COLUMNS = (
    "task_id", "proc_inst_id", "task_definition_key", "task_name",
    "task_start_date", "task_claim_date", "task_end_date", "task_start_time", "task_claim_time", "task_end_time",
    "status_daily", "status_weekly", "status_monthly", *DIMENSIONS,
    "mo_number", "model_name", "delivery_area", "schedule_number", "sap_plant", "sap_product_group",
    "pallet", "transfer_no", "qblock_event_id", "defect_sn",
    "duration_min", "processing_time_min", "assignee_code", "assignee_name", "l4_process_id", "l4_process_name",
)


def in_period_months(summary: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """The rows of periods that begin between two days, by month folder where the summary is stored in them.

    Literals prune the folders at planning time; a summary without ``period_month`` is returned as it is."""
    if "period_month" not in summary.columns:
        return summary
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    months = [first.year * 12 + first.month - 1 + k for k in range(count)]
    return summary.where(F.col("period_month").isin([f"{m // 12}{m % 12 + 1:02d}" for m in months]))


def anchor_date(summary: DataFrame, as_of: DateLike, date_from: DateLike | None = None,
                date_to: DateLike | None = None, **dims) -> DataFrame:
    """One cell: the newest Day date of the selection, at most ``as_of``; NULL for an empty selection."""
    days = filter_dims(summary.where(F.col("period_type") == "Day"), **dims)
    if date_from is not None:
        days = days.where(F.col("snapshot_date") >= as_date(date_from))
    if date_to is not None:
        days = days.where(F.col("snapshot_date") <= as_date(date_to))
    newest, today = F.max("snapshot_date"), as_date(as_of)
    return days.agg(F.when(newest >= today, today).otherwise(newest).alias("anchor"))


def periodic_report(summary: DataFrame, anchor: DateLike, days: int = 7, **dims) -> DataFrame:
    """The anchor's month, its ISO week and the two before, and the last ``days`` days, in one scan.

    Pass the anchor as a date where the summary is large: literals reach the parquet filters, a scalar
    subquery does not.
    """
    a = as_date(anchor)
    if isinstance(anchor, (str, dt.date)):
        known = dt.date.fromisoformat(str(anchor)[:10])
        monday = known - dt.timedelta(days=known.weekday() + 14)
        summary = in_period_months(summary, min(monday, known - dt.timedelta(days=days - 1), known.replace(day=1)), known)
        calendar = [(known - dt.timedelta(weeks=back)).isocalendar() for back in range(3)]
        month, weeks = f"{known.year}-{known.month:02d}", [f"{week.year}-W{week.week:02d}" for week in calendar]
    else:
        month, weeks = month_key(a), [week_key(F.date_sub(a, 7 * back)) for back in range(3)]
    kind, key, day = F.col("period_type"), F.col("period_key"), F.col("snapshot_date")
    in_month = (kind == "Month") & (key == month)
    in_week = (kind == "Week") & (key == weeks[0])
    in_week_1 = (kind == "Week") & (key == weeks[1])
    in_week_2 = (kind == "Week") & (key == weeks[2])
    in_days = (kind == "Day") & day.between(F.date_sub(a, days - 1), a)
    sort_order = (
        F.when(in_month, 1).when(in_week, 2).when(in_week_1, 3).when(in_week_2, 4)
        .otherwise(F.lit(5) + F.date_diff(a, day))
    )
    return (
        filter_dims(summary, **dims)
        .where(in_month | in_week | in_week_1 | in_week_2 | in_days)
        .select(
            kind.alias("granularity"), "period_name", sort_order.cast("int").alias("sort_order"), *DIMENSIONS,
            a.alias("filter_date"), day.alias("snapshot_date_real"), *QTY,
        )
    )


def periodic_measures(report: DataFrame, by=("granularity", "period_name")) -> DataFrame:
    """Sums, floor percents and sort order. The backlog rate uses acc_total on days, the cohort on longer grains."""
    sums = report.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in QTY],
        F.max("sort_order").alias("period_sort_order"),
        F.bool_and(F.col("granularity") == "Day").alias("_days"),
    )
    total, todo, doing = F.col("total_qty"), F.col("todo_qty"), F.col("doing_qty")
    acc, acc_total = F.col("acc_qty"), F.col("acc_total_qty")
    return sums.withColumns({
        "effective_denominator": total,
        "todo_rate": floor_rate(todo, total),
        "doing_rate": floor_rate(doing, total),
        "done_rate": capped_floor_rate(F.col("done_qty"), total),
        "doing_done_rate": capped_floor_rate(F.col("doing_done_qty"), total),
        "acc_rate": F.when(F.col("_days"), capped_floor_rate(acc, acc_total))
        .otherwise(floor_rate(todo + doing, total)),
    }).drop("_days")


def _status_lines(df: DataFrame, percents: dict, sort_name: str, keep: list[str]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(name).alias("status_name"), F.col(qty).alias("task_qty"),
            percents[qty].cast("double").alias("task_pct"), F.lit(i).alias(sort_name),
        )
        for i, (name, qty) in enumerate(STATUS_LINES, start=1)
    ]
    return df.select(*keep, F.inline(F.array(*lines)))


def periodic_pivot(report: DataFrame) -> DataFrame:
    """Six status rows per report row; the backlog percent uses acc_total for every grain."""
    total = F.col("total_qty")
    percents = {
        "total_qty": F.lit(100.0),
        "todo_qty": floor_rate(F.col("todo_qty"), total),
        "doing_qty": floor_rate(F.col("doing_qty"), total),
        "done_qty": capped_floor_rate(F.col("done_qty"), total),
        "doing_done_qty": capped_floor_rate(F.col("doing_done_qty"), total),
        "acc_qty": capped_floor_rate(F.col("acc_qty"), F.col("acc_total_qty")),
    }
    keep = [*DIMENSIONS, "filter_date", "snapshot_date_real", "granularity", "period_name", "period_sort"]
    return _status_lines(report.withColumnRenamed("sort_order", "period_sort"), percents, "status_sort", keep)


def pivot_measures(pivot: DataFrame, by=("granularity", "period_name", "status_name")) -> DataFrame:
    """Summed quantity, mean percent and period order of the status rows."""
    return pivot.groupBy(*by).agg(
        F.sum("task_qty").alias("task_qty"),
        F.avg("task_pct").alias("task_pct"),
        F.max("period_sort").alias("period_sort_order"),
    )


def task_details(fact: DataFrame, **dims) -> DataFrame:
    """Counted tasks with the columns a reader needs; the fact holds one row per task."""
    return filter_dims(fact.where(F.col("is_excluded") == 0), **dims).select(*DETAIL_COLUMNS)


def detail_measures(details: DataFrame, by=()) -> DataFrame:
    """Distinct tasks and mean processing minutes; grouped by task first, which keeps a hot group spread out."""
    per_task = details.groupBy(*by, "task_id").agg(
        F.sum("processing_time_min").alias("_minutes"), F.count("processing_time_min").alias("_timed")
    )
    return per_task.groupBy(*by).agg(
        F.count("task_id").alias("task_count"),
        (F.sum("_minutes") / F.nullif(F.sum("_timed"), F.lit(0))).alias("avg_processing_time_min"),
    )


def audit_drill(fact: DataFrame, day: DateLike, status: str = "done", **dims) -> DataFrame:
    """The tasks behind one KPI cell, newest first."""
    rows = filter_dims(fact.where(F.col("is_excluded") == 0), **dims)
    return status_on_day(rows, day, status).orderBy(
        F.col("task_end_time").desc_nulls_last(), F.col("task_start_time").desc_nulls_last(), "task_id"
    )


def report_calendar(month: str) -> dict:
    """Labels of a 'yyyy-MM' report: its last seven days, last three ISO weeks and name."""
    try:
        first = dt.datetime.strptime(month, "%Y-%m").date()
    except ValueError as error:
        raise ValueError(f"month must be yyyy-MM, got {month!r}") from error
    following = (first + dt.timedelta(days=32)).replace(day=1)
    last = following - dt.timedelta(days=1)
    return {
        "month_label": f"{first:%b}.",
        "days": [str(last - dt.timedelta(days=i)) for i in range(7)],
        "weeks": [f"W{(last - dt.timedelta(weeks=i)).isocalendar().week}" for i in range(3)],
        "first": first,
        "last": last,
    }


def _slot(condition: Column, **fields: Column) -> Column:
    """One report column a row belongs to, or NULL."""
    return F.when(condition, F.struct(*[value.alias(name) for name, value in fields.items()]))


def monthly_report(summary: DataFrame, month: str, **dims) -> DataFrame:
    """Long form of the monthly report: month, last three ISO weeks and last seven days x six statuses.

    Month and weeks add up the Day rows; their backlog is each level combination's newest day, summed.
    """
    calendar = report_calendar(month)
    first, last = F.lit(calendar["first"]), F.lit(calendar["last"])
    monday = calendar["last"] - dt.timedelta(days=calendar["last"].weekday())
    summary = in_period_months(summary, min(calendar["first"], monday - dt.timedelta(days=14)), monday + dt.timedelta(days=6))
    days = filter_dims(summary.where(F.col("period_type") == "Day"), **dims).select(
        "snapshot_date", *DIMENSIONS, "total_qty", "todo_qty", "doing_qty", "done_qty", "acc_qty"
    )
    day = F.col("snapshot_date")
    first_week = F.date_sub(F.trunc(last, "week"), 14)
    last_day_of_weeks = F.date_add(F.trunc(last, "week"), 6)
    slots = F.array(
        _slot(day.between(first, last), period_type=F.lit("Monthly"), label=F.lit("Total")),
        _slot(day.between(first_week, last_day_of_weeks), period_type=F.lit("Weekly"), label=week_name(day)),
        _slot(day.between(F.date_sub(last, 6), last), period_type=F.lit("Daily"), label=day.cast("string")),
    )
    slotted = days.where(day.between(F.least(first, first_week), F.greatest(last, last_day_of_weeks))).select(
        F.inline(slots), *days.columns
    ).where(F.col("label").isNotNull())
    totals = latest_then_sum(
        slotted, by=["period_type", "label"], within=["plant", "factory", "line", "vx_type", "region"],
        order_col="snapshot_date", sums=["total_qty", "todo_qty", "doing_qty", "done_qty"], latest=["acc_qty"],
    ).withColumn("doing_done_qty", F.col("doing_qty") + F.col("done_qty"))
    lines = F.array(*[
        F.struct(
            F.lit(i).alias("status_sort"), F.lit(name.split(". ")[1]).alias("status"), F.col(qty).alias("qty"),
            (F.lit("-") if qty == "total_qty" else percent_text(F.col(qty), F.col("total_qty"))).alias("percentage"),
        )
        for i, (name, qty) in enumerate(STATUS_LINES, start=1)
    ])
    return totals.select("period_type", "label", F.inline(lines))


def legacy_periodic_report(days: DataFrame, anchor: DateLike) -> DataFrame:
    """Older layout from Day rows alone: summed month, three summed ISO weeks, eight single days."""
    a = as_date(anchor)
    day = F.col("snapshot_date")
    month_start, week_start = F.trunc(a, "month"), F.trunc(a, "week")
    weeks_back = F.expr("div(datediff(_week_start, trunc(snapshot_date, 'week')), 7)")
    slots = F.array(
        _slot(day.between(month_start, F.last_day(a)), period_name=month_name(a), sort_order=F.lit(1)),
        _slot((day >= F.date_sub(week_start, 14)) & (day < F.date_add(week_start, 7)),
              period_name=week_name(day), sort_order=(F.lit(2) + weeks_back).cast("int")),
        _slot(day.between(F.date_sub(a, 7), a),
              period_name=day.cast("string"), sort_order=(F.lit(5) + F.date_diff(a, day)).cast("int")),
    )
    rows = days.where(F.col("period_type") == "Day").withColumn("_week_start", week_start)
    sums = ("total_qty", "done_qty", "doing_qty", "todo_qty", "acc_qty")
    return (
        rows.where(day.between(F.least(month_start, F.date_sub(week_start, 14)),
                               F.greatest(F.last_day(a), F.date_add(week_start, 6))))
        .select(F.inline(slots), *DIMENSIONS, *sums).where(F.col("sort_order").isNotNull())
        .groupBy("period_name", "sort_order", *DIMENSIONS)
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def legacy_periodic_measures(report: DataFrame) -> DataFrame:
    """Sums per period and percents rounded to two digits."""
    sums = report.groupBy("period_name", "sort_order").agg(
        *[F.sum(c).alias(c) for c in ("total_qty", "done_qty", "doing_qty", "todo_qty", "acc_qty")]
    )
    total, todo, doing, done = (F.col(f"{c}_qty") for c in ("total", "todo", "doing", "done"))
    return sums.withColumns({
        "todo_doing_qty": todo + doing, "doing_done_qty": doing + done,
        "done_rate": rounded_rate(done, total), "doing_rate": rounded_rate(doing, total),
        "todo_rate": rounded_rate(todo, total), "todo_doing_rate": rounded_rate(todo + doing, total),
        "doing_done_rate": rounded_rate(doing + done, total),
    })


def legacy_status_pivot(days: DataFrame) -> DataFrame:
    """Six status rows per Day row; every percent is of the total, rounded to two digits."""
    total = F.col("total_qty")
    percents = {qty: rounded_rate(F.col(qty), total) for _, qty in STATUS_LINES}
    percents["total_qty"] = F.lit(100.0)
    rows = days.where(F.col("period_type") == "Day")
    return _status_lines(rows, percents, "sort_order", ["snapshot_date", *DIMENSIONS])


def trend_view(summary: DataFrame) -> DataFrame:
    """Date, levels, counts and rates of every grain under the names trend charts use."""
    rated = composite_rates(summary)
    total = F.col("total_qty")
    return rated.select(
        F.col("snapshot_date").alias("snapshotDate"), F.col("vx_type").alias("vxType"), "region", "plant", "factory",
        "line", F.col("period_type").alias("timePeriodType"), F.col("period_key").alias("periodKey"),
        total.alias("totalTaskQty"), F.col("todo_qty").alias("todoQty"), F.col("doing_qty").alias("doingQty"),
        F.col("done_qty").alias("doneQty"), F.col("todo_doing_qty").alias("inProgressQty"),
        floor_rate(F.col("done_qty"), total).alias("completionRate"),
        floor_rate(F.col("doing_done_qty"), total).alias("executionRate"),
        F.col("completion_rate").alias("completionRateCalc"), F.col("execution_rate").alias("executionRateCalc"),
    )


def dim_values(summary: DataFrame) -> DataFrame:
    """Distinct level combinations for filter menus."""
    return summary.select(*DIMENSIONS).distinct()


def settled_now(fact: DataFrame) -> DataFrame:
    """The fact with week and month status computed again from the dates."""
    return fact.withColumns({
        "status_weekly": cohort_status("Week"), "status_monthly": cohort_status("Month"),
    })


def file_months(fact: DataFrame, cutoff: str) -> DataFrame:
    """Counted tasks once per month file they belong to.

    The opening month always; claim and end months only before the cutoff month. ``in_month_cohort`` is 1 in
    the opening month's file.
    """
    first_current = cutoff[:7]
    opened = month_key("task_start_date")
    others = [F.when(month_key(c) < first_current, month_key(c)) for c in TASK_DATES[1:]]
    return (
        settled_now(fact.where(F.col("is_excluded") == 0))
        .withColumn("file_month", F.explode(F.array_distinct(F.array(opened, *others))))
        .where(F.col("file_month").isNotNull())
        .withColumn("in_month_cohort", (F.col("file_month") == opened).cast("int"))
    )


def serving_view(gold: DataFrame, name: str) -> DataFrame:
    """Publish a stable column list of the completion table under ``name``."""
    view = gold.select(
        "snapshot_date", *DIMENSIONS, "total_task",
        *[f"{s}_{p}" for p in ("daily", "weekly", "monthly") for s in ("todo", "doing", "done")],
        "acc", "acc_total_task", "calendar_year", "iso_year", "iso_week", "iso_month",
    )
    view.createOrReplaceTempView(name)
    return view
