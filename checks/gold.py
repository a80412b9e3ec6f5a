"""KPI checks: cohort cells, backlog, completion, and the summary under both regimes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.functions.dates import calendar_labels, period_key, period_name, period_start, period_end
from cohortmill.operators import cohort, rollups, summary
from cohortmill.operators import task_sets as set_operators
from cohortmill.operators.facts import add_statuses
from cohortmill.operators.filters import filter_dims
from cohortmill.operators.versions import merge_states, set_states, state_counts
from cohortmill.plans import reports, task_sets
from cohortmill.session import scratch_path
from checks import adapter as a
from checks.base import Check
from checks.oracle import DIMS, SUMMARY_COLS, ctes, month_key, month_name, week_key, week_name, week_start


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return a.derive(spark, sf, a.TASK_FACT)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return add_statuses(fact(spark, sf), "assignee_code")


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return cohort.cohort_cells(fact(spark, sf))


def completed(spark: SparkSession, sf: str) -> DataFrame:
    c = cells(spark, sf)
    return cohort.completion(cohort.milestone(c), cohort.acc_rolling(c))


def whole_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary.task_summary(fact(spark, sf), a.CUTOFF, a.AS_OF)


def status_labels(spark, sf):
    return labelled(spark, sf).select("task_id", "task_status", "status_daily", "status_weekly", "status_monthly")


def zero_days(spark, sf):
    c = cells(spark, sf)
    backlog = cohort.acc_rolling(c)
    return cohort.zero_open_days(backlog, cohort.completion(cohort.milestone(c), backlog))


def set_cardinalities(spark, sf):
    """The same doing / done counts from persisted bitmaps, merged after a split by factory."""
    rows = labelled(spark, sf).where("is_excluded = 0").withColumn("id", F.col("task_id").cast("bigint"))
    status = F.col("status_monthly")
    month = rows.withColumn("month", F.date_format("task_start_date", "yyyy-MM"))
    states = {"doing": status == "DOING", "done": status == "DONE", "doing_or_done": status.isin("DOING", "DONE")}
    split = set_states(month, ["month", "region", "factory"], "id", states)
    merged = merge_states(split, ["month", "region"], list(states))
    return state_counts(merged, ["month", "region"], list(states))


def stored_sets(spark, sf):
    """Daily sets stored in two runs: the dictionary grows, the months of the second run are added."""
    root = scratch_path(spark, "task-sets")
    ids, sets = f"{root}/ids", f"{root}/sets"
    tasks = fact(spark, sf)
    early = F.col("task_start_date") < a.CUTOFF
    for part in (tasks.where(early), tasks.where(~early)):
        task_sets.extend_dictionary(part, ids)
        task_sets.write_sets(part, task_sets.read_dictionary(spark, ids), sets)
    return task_sets.read_dictionary(spark, ids), task_sets.read_sets(spark, sets)


def dictionary_facts(spark, sf):
    """What makes the numbers dense: as many as tasks, from 0 to one less, each once."""
    ids, _ = stored_sets(spark, sf)
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("tasks"))
    return per_id.agg(F.sum("tasks").alias("tasks"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                      F.max("tasks").alias("most_per_id"))


def backlog_from_sets(spark, sf):
    """Week and month backlog totals from merged daily sets."""
    _, opened = stored_sets(spark, sf)
    parts = [set_operators.backlog_totals(opened, grain).select(
        F.lit(grain).alias("period_type"), period_key(grain, F.col("period_start")).alias("period_key"), *DIMENSIONS,
        "acc_total_qty") for grain in ("Week", "Month")]
    return parts[0].unionByName(parts[1])


def regimes(spark, sf):
    return whole_summary(spark, sf).select(*summary.SUMMARY_COLUMNS)


def widened_periods(spark, sf):
    """Whole ISO weeks and months around each day."""
    days = fact(spark, sf).select(F.col("task_start_date").alias("day")).distinct()
    return days.select(
        "day", period_start("Week", "day").alias("week_from"), period_end("Week", "day").alias("week_to"),
        period_start("Month", "day").alias("month_from"), period_end("Month", "day").alias("month_to"),
    )


def labels(spark, sf):
    days = fact(spark, sf).select(F.col("task_start_date").alias("day")).distinct()
    return days.select(
        "day", *calendar_labels("day"),
        *[period_key(g, "day").alias(f"{g.lower()}_key") for g in ("Day", "Week", "Month")],
        *[period_name(g, "day").alias(f"{g.lower()}_name") for g in ("Week", "Month")],
    )


def rolling_frame(spark, sf):
    """Backlog total per region from daily counts."""
    return cohort.rolling_total(cells(spark, sf), ["region"], "snapshot_date", "total_task", "acc_total")


def served(spark, sf):
    reports.serving_view(cohort.completion_from_cells(cells(spark, sf)), "task_completion")
    return spark.table("task_completion")


def _summary_from(cte: str) -> str:
    return ctes.sql(f"SELECT {SUMMARY_COLS} FROM {cte}")


CHECKS = [
    Check("day_cohort_summary", lambda s, d: filter_dims(
        summary.day_summary(cells(s, d)).where("total_qty > 0"), vx_type="ALL", region=None
    ).withColumn("done_rate", reports.capped_floor_rate(F.col("done_qty"), F.col("total_qty"))),
        ctes.sql(f"""SELECT {SUMMARY_COLS}, CAST(CASE WHEN done_qty >= total_qty THEN 100
                 ELSE floor(done_qty * 100.0 / total_qty) END AS INT) AS done_rate FROM day_rows WHERE total_qty > 0""")),
    Check("cohort_status_labels", status_labels, ctes.sql(
        "SELECT task_id, task_status, status_daily, status_weekly, status_monthly FROM labelled")),
    Check("cohort_milestones", lambda s, d: cohort.milestone(cells(s, d)), ctes.sql("SELECT * FROM milestones")),
    Check("rolling_backlog", lambda s, d: cohort.acc_rolling(cells(s, d)), ctes.sql("SELECT * FROM backlog")),
    Check("rolling_backlog_by_region", rolling_frame, ctes.sql("""
        SELECT region, CAST(task_start_date + CAST(k AS INT) AS DATE) AS snapshot_date, count(*) AS acc_total
        FROM counted, range(7) steps(k) GROUP BY 1, 2""")),
    Check("task_completion", lambda s, d: cohort.completion_from_cells(cells(s, d)), ctes.sql("SELECT * FROM completed")),
    Check("milestone_backlog_join", completed, ctes.sql("SELECT * FROM completed")),
    Check("serving_view", served, ctes.sql("SELECT * FROM completed")),
    Check("zero_open_days", zero_days, ctes.sql("SELECT * FROM zero_days")),
    Check("day_summary", lambda s, d: summary.day_summary(cells(s, d)), _summary_from("day_rows")),
    Check("week_summary", lambda s, d: summary.week_summary(cells(s, d)), _summary_from("week_rows")),
    Check("month_summary", lambda s, d: summary.month_summary(cells(s, d)), _summary_from("month_rows")),
    Check("historical_day_summary", lambda s, d: summary.historical_day_summary(fact(s, d), cells(s, d), a.AS_OF),
          _summary_from("hist_day_rows")),
    Check("historical_week_summary", lambda s, d: summary.historical_cohort_summary(cells(s, d), "Week", a.CUTOFF),
          _summary_from("hist_week_rows")),
    Check("historical_month_summary", lambda s, d: summary.historical_cohort_summary(cells(s, d), "Month", a.CUTOFF),
          _summary_from("hist_month_rows")),
    Check("historical_week_keeping_cross_year",
          lambda s, d: summary.historical_cohort_summary(cells(s, d), "Week", drop_cross_year=False),
          ctes.sql(f"""
        SELECT period_type, period_key, snapshot_date, sort_order, period_name, {DIMS}, total_qty, todo_qty, doing_qty,
               done_qty, doing_done_qty, acc_qty, total_qty AS acc_total_qty FROM week_rows""")),
    Check("summary_across_cutoff", regimes, ctes.sql("SELECT * FROM summary")),
    Check("bitmap_state_counts", set_cardinalities, ctes.sql(f"""
        SELECT {month_key('task_start_date')} AS month, region,
               count(DISTINCT CASE WHEN status_monthly = 'DOING' THEN task_id END) AS doing,
               count(DISTINCT CASE WHEN status_monthly = 'DONE' THEN task_id END) AS done,
               count(DISTINCT CASE WHEN status_monthly <> 'TODO' THEN task_id END) AS doing_or_done
        FROM counted GROUP BY 1, 2""")),
    Check("task_id_dictionary", dictionary_facts, ctes.sql("""
        SELECT count(DISTINCT task_id) AS tasks, CAST(0 AS BIGINT) AS first_id, count(DISTINCT task_id) - 1 AS last_id,
               CAST(1 AS BIGINT) AS most_per_id FROM fact""")),
    Check("bitmap_backlog_by_period", backlog_from_sets, ctes.sql(f"""
        SELECT period_type, period_key, {DIMS}, acc_total_qty FROM week_rows
        UNION ALL SELECT period_type, period_key, {DIMS}, acc_total_qty FROM month_rows""")),
    Check("period_range_expansion", widened_periods, ctes.sql(f"""
        SELECT DISTINCT task_start_date AS day, {week_start('task_start_date')} AS week_from,
               {week_start('task_start_date')} + 6 AS week_to,
               CAST(date_trunc('month', task_start_date) AS DATE) AS month_from, last_day(task_start_date) AS month_to
        FROM fact""")),
    Check("calendar_and_period_labels", labels, ctes.sql(f"""
        SELECT DISTINCT task_start_date AS day, CAST(year(task_start_date) AS INT) AS calendar_year,
               CAST(isoyear(task_start_date) AS INT) AS iso_year, CAST(weekofyear(task_start_date) AS INT) AS iso_week,
               CAST(month(task_start_date) AS INT) AS iso_month, CAST(task_start_date AS VARCHAR) AS day_key,
               {week_key('task_start_date')} AS week_key, {month_key('task_start_date')} AS month_key,
               {week_name('task_start_date')} AS week_name, {month_name('task_start_date')} AS month_name
        FROM fact""")),
    Check("rollup_daily_vx", lambda s, d: rollups.rollup_table(
        summary.day_summary(cells(s, d)), ["vx_type", "region", "plant"],
        ["total_qty", "todo_qty", "doing_qty", "done_qty"]), ctes.sql("""
        SELECT snapshot_date, vx_type, region, plant, CAST(sum(total_qty) AS BIGINT) AS total_qty,
               CAST(sum(todo_qty) AS BIGINT) AS todo_qty, CAST(sum(doing_qty) AS BIGINT) AS doing_qty,
               CAST(sum(done_qty) AS BIGINT) AS done_qty
        FROM day_rows GROUP BY 1, 2, 3, 4""")),
    Check("rollup_full_dimensions", lambda s, d: rollups.rollup_table(
        summary.day_summary(cells(s, d)), ["region", "plant", "factory", "line", "vx_type"],
        ["total_qty", "done_qty"]), ctes.sql(f"""
        SELECT snapshot_date, {DIMS}, CAST(sum(total_qty) AS BIGINT) AS total_qty,
               CAST(sum(done_qty) AS BIGINT) AS done_qty FROM day_rows GROUP BY snapshot_date, {DIMS}""")),
    Check("user_utilization", lambda s, d: rollups.user_utilization(labelled(s, d)).withColumns({
        "utilization_rate": F.round("utilization_rate", 6), "tasks_per_user": F.round("tasks_per_user", 6)}),
        ctes.sql("""
        SELECT task_start_date AS snapshot_date, vx_type, plant, count(DISTINCT assignee_code) AS active_users,
               count(DISTINCT CASE WHEN status_daily <> 'DONE' THEN assignee_code END) AS working_users,
               count(DISTINCT CASE WHEN status_daily = 'DONE' THEN assignee_code END) AS completed_users,
               count(*) AS total_tasks, count(CASE WHEN status_daily = 'DONE' THEN 1 END) AS done_tasks,
               round(count(DISTINCT CASE WHEN status_daily <> 'DONE' THEN assignee_code END) * 100.0
                     / count(DISTINCT assignee_code), 6) AS utilization_rate,
               round(count(*) * 1.0 / count(DISTINCT assignee_code), 6) AS tasks_per_user
        FROM counted WHERE assignee_code <> '' GROUP BY 1, 2, 3""")),
    Check("rollup_user_utilization", lambda s, d: rollups.user_utilization(labelled(s, d)).groupBy("snapshot_date").agg(
        *[F.sum(c).alias(c) for c in ("active_users", "working_users", "total_tasks", "done_tasks")]), ctes.sql("""
        SELECT snapshot_date, CAST(sum(au) AS BIGINT) AS active_users, CAST(sum(wu) AS BIGINT) AS working_users,
               CAST(sum(tt) AS BIGINT) AS total_tasks, CAST(sum(dt) AS BIGINT) AS done_tasks
        FROM (SELECT task_start_date AS snapshot_date, vx_type, plant, count(DISTINCT assignee_code) AS au,
                     count(DISTINCT CASE WHEN status_daily <> 'DONE' THEN assignee_code END) AS wu, count(*) AS tt,
                     count(CASE WHEN status_daily = 'DONE' THEN 1 END) AS dt
              FROM counted WHERE assignee_code <> '' GROUP BY 1, 2, 3)
        GROUP BY 1""")),
]
