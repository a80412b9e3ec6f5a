"""Report checks over the summary and the task fact."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortmill.operators import rollups, summary
from cohortmill.operators.filters import filter_dims, status_on_day, touching_month
from cohortmill.plans import daily, reports, rollup_store
from cohortmill.session import scratch_path
from cohortmill.sources import export
from checks import adapter as a
from checks.base import Check
from checks.gold import cells, fact, labelled, whole_summary
from checks.oracle import DIMS, ctes, month_key, month_name, week_key, week_name, week_start
from checks.silver import rounded, silver_fact

ANCHOR_AS_OF = "2000-03-15"
MONTH = "2000-03"
DRILL_DAY = "1998-06-15"

ctes.add("anchor", f"""
SELECT CASE WHEN max(snapshot_date) >= DATE '{ANCHOR_AS_OF}' THEN DATE '{ANCHOR_AS_OF}' ELSE max(snapshot_date) END AS d
FROM summary WHERE period_type = 'Day'
""")
_KEEP = f"{DIMS}, d AS filter_date, snapshot_date AS snapshot_date_real, total_qty, todo_qty, doing_qty, doing_done_qty, done_qty, acc_qty, acc_total_qty"
ctes.add("report", f"""
SELECT 'Month' AS granularity, period_name, 1 AS sort_order, {_KEEP} FROM summary, anchor
WHERE period_type = 'Month' AND period_key = {month_key('d')}
UNION ALL
SELECT 'Week', period_name, CASE WHEN period_key = {week_key('d')} THEN 2 WHEN period_key = {week_key('(d - 7)')} THEN 3
       ELSE 4 END, {_KEEP} FROM summary, anchor
WHERE period_type = 'Week' AND period_key IN ({week_key('d')}, {week_key('(d - 7)')}, {week_key('(d - 14)')})
UNION ALL
SELECT 'Day', period_name, CAST(5 + date_diff('day', snapshot_date, d) AS INT), {_KEEP} FROM summary, anchor
WHERE period_type = 'Day' AND snapshot_date BETWEEN d - 6 AND d
""")


def _floor(part: str, whole: str) -> str:
    return f"CAST(floor({part} * 100.0 / NULLIF({whole}, 0)) AS INT)"


def _capped(part: str, whole: str) -> str:
    return f"CASE WHEN {part} >= {whole} THEN 100 ELSE {_floor(part, whole)} END"


_LINES = (("1. Total Task", "total_qty", "100.0"), ("2. Todo", "todo_qty", _floor("todo_qty", "total_qty")),
          ("3. Doing", "doing_qty", _floor("doing_qty", "total_qty")),
          ("4. Done", "done_qty", _capped("done_qty", "total_qty")),
          ("5. Doing+Done", "doing_done_qty", _capped("doing_done_qty", "total_qty")),
          ("6. Todo+Doing(Acc)", "acc_qty", _capped("acc_qty", "acc_total_qty")))
ctes.add("pivoted_report", "\nUNION ALL\n".join(
    f"SELECT {DIMS}, filter_date, snapshot_date_real, granularity, period_name, sort_order AS period_sort, "
    f"'{name}' AS status_name, {qty} AS task_qty, CAST({pct} AS DOUBLE) AS task_pct, {i} AS status_sort FROM report"
    for i, (name, qty, pct) in enumerate(_LINES, start=1)))
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in reports.QTY)


def anchor(spark, sf):
    return reports.anchor_date(whole_summary(spark, sf), ANCHOR_AS_OF)


def report(spark, sf, **dims):
    whole = whole_summary(spark, sf)
    return reports.periodic_report(whole, reports.anchor_date(whole, ANCHOR_AS_OF), **dims)


def stored_rollups(spark, sf):
    """A stored summary with its rollups; half of the months are renewed once more, which must change nothing."""
    path = f"{scratch_path(spark, 'rollups')}/summary"
    daily.write_summary(whole_summary(spark, sf), path)
    stored, root = daily.read_summary(spark, path), rollup_store.rollup_path(path)
    rollup_store.store_rollups(stored, root)
    months = daily.calendar_months(stored.select("period_month"))
    rollup_store.refresh_rollups(stored, root, months[::2])
    return stored, root


def lattice_rows(spark, sf):
    _, root = stored_rollups(spark, sf)
    return rollup_store.read_rollups(spark, root).select("rollup", *summary.SUMMARY_COLUMNS)


def served_measures(spark, sf):
    """Two reports from the rollups that cover them; without the levels of any rollup, from the summary."""
    stored, root = stored_rollups(spark, sf)
    last = reports.anchor_date(rollup_store.serve(stored, root), ANCHOR_AS_OF).first()["anchor"]
    parts = []
    for name, by, dims in (("whole", [], {}), ("regions", ["region"], {"vx_type": "V1"}), ("lines", ["line"], {"vx_type": "V3"})):
        by = ["granularity", "period_name", *by]
        rows = reports.periodic_report(rollup_store.serve(stored, root, by, **dims), last, **dims)
        level = F.col(by[2]) if by[2:] else F.lit("")
        parts.append(reports.periodic_measures(rows, by).select(
            F.lit(name).alias("report"), "granularity", "period_name", level.alias("level"), *reports.QTY,
            "period_sort_order", "acc_rate", "done_rate"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _served(name: str, level: str, where: str) -> str:
    return f"""SELECT '{name}' AS report, *, CASE WHEN granularity = 'Day' THEN {_capped('acc_qty', 'acc_total_qty')}
           ELSE {_floor('(todo_qty + doing_qty)', 'total_qty')} END AS acc_rate, {_capped('done_qty', 'total_qty')} AS done_rate
    FROM (SELECT granularity, period_name, {level} AS level, {_SUMS}, max(sort_order) AS period_sort_order
          FROM report WHERE {where} GROUP BY 1, 2, 3)"""


def _lattice_sql() -> str:
    """Each rollup as a query of its own."""
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in summary.QUANTITIES)
    parts = []
    for name, kept in rollup_store.LATTICE.items():
        levels = ", ".join(d if d in kept else f"CAST(NULL AS VARCHAR) AS {d}" for d in DIMS.split(", "))
        groups = ", ".join(["period_type", "period_key", "sort_order", "period_name", *kept])
        parts.append(f"SELECT '{name}' AS rollup, period_type, period_key, max(snapshot_date) AS snapshot_date, sort_order, "
                     f"period_name, {levels}, {sums} FROM summary GROUP BY {groups}")
    return " UNION ALL ".join(parts)


def anchors_per_region(spark, sf):
    """One anchor per selection: a wide one, one with a date range, an empty one."""
    whole = whole_summary(spark, sf)
    picks = {
        "all": reports.anchor_date(whole, ANCHOR_AS_OF),
        "future": reports.anchor_date(whole, "2030-01-01"),
        "until": reports.anchor_date(whole, ANCHOR_AS_OF, date_to="1997-05-05"),
        "none": reports.anchor_date(whole, ANCHOR_AS_OF, region="nowhere"),
    }
    parts = [df.select(F.lit(name).alias("pick"), "anchor") for name, df in picks.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def day_rows(spark, sf):
    return summary.day_summary(cells(spark, sf))


def composites(spark, sf):
    rates = ("todo_rate", "doing_rate", "done_rate", "completion_rate", "execution_rate")
    rated = rollups.composite_rates(day_rows(spark, sf))
    return rated.select("snapshot_date", *DIMS.split(", "), "todo_doing_qty", "doing_done_qty",
                        *[F.round(r, 6).alias(r) for r in rates])


def trend(spark, sf):
    view = reports.trend_view(whole_summary(spark, sf))
    return view.withColumns({c: F.round(c, 6) for c in ("completionRateCalc", "executionRateCalc")})


def monthly(spark, sf):
    return reports.monthly_report(day_rows(spark, sf), MONTH)


def legacy(spark, sf):
    return reports.legacy_periodic_report(day_rows(spark, sf), ANCHOR_AS_OF)


_RATES6 = ", ".join(
    f"round(CASE WHEN total_qty > 0 THEN ({n}) * 100.0 / total_qty ELSE 0 END, 6) AS {name}"
    for name, n in (("todo_rate", "todo_qty"), ("doing_rate", "doing_qty"), ("done_rate", "done_qty"),
                    ("completion_rate", "done_qty"), ("execution_rate", "doing_qty + done_qty")))

_LAST = "DATE '2000-03-31'"
_MONTH_TOTALS = """
  SELECT period_type, label, CAST(sum(total) AS BIGINT) AS total_qty, CAST(sum(todo) AS BIGINT) AS todo_qty,
         CAST(sum(doing) AS BIGINT) AS doing_qty, CAST(sum(done) AS BIGINT) AS done_qty,
         CAST(sum(doing) + sum(done) AS BIGINT) AS doing_done_qty, CAST(sum(acc) AS BIGINT) AS acc_qty
  FROM (SELECT period_type, label, vx_type, region, plant, factory, line, sum(total_qty) AS total, sum(todo_qty) AS todo,
               sum(doing_qty) AS doing, sum(done_qty) AS done, arg_max(acc_qty, snapshot_date) AS acc
        FROM slotted GROUP BY ALL) GROUP BY 1, 2
"""
ctes.add("slotted", f"""
SELECT 'Monthly' AS period_type, 'Total' AS label, d.* EXCLUDE (period_type) FROM day_rows d
WHERE {month_key('snapshot_date')} = '{MONTH}'
UNION ALL
SELECT 'Weekly', {week_name('snapshot_date')}, d.* EXCLUDE (period_type) FROM day_rows d
WHERE snapshot_date BETWEEN {week_start(_LAST)} - 14 AND {week_start(_LAST)} + 6
UNION ALL
SELECT 'Daily', CAST(snapshot_date AS VARCHAR), d.* EXCLUDE (period_type) FROM day_rows d
WHERE snapshot_date BETWEEN {_LAST} - 6 AND {_LAST}
""")
ctes.add("month_totals", _MONTH_TOTALS)
_A = f"DATE '{ANCHOR_AS_OF}'"
_LEGACY_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in
                         ("total_qty", "done_qty", "doing_qty", "todo_qty", "acc_qty"))
ctes.add("legacy_rows", f"""
SELECT {month_name(_A)} AS period_name, 1 AS sort_order, {DIMS}, {_LEGACY_SUMS} FROM day_rows
WHERE {month_key('snapshot_date')} = {month_key(_A)} GROUP BY {DIMS}
UNION ALL
SELECT {week_name('snapshot_date')}, CASE WHEN snapshot_date >= {week_start(_A)} THEN 2
       WHEN snapshot_date >= {week_start(_A)} - 7 THEN 3 ELSE 4 END, {DIMS}, {_LEGACY_SUMS} FROM day_rows
WHERE snapshot_date >= {week_start(_A)} - 14 AND snapshot_date < {week_start(_A)} + 7 GROUP BY 1, 2, {DIMS}
UNION ALL
SELECT CAST(snapshot_date AS VARCHAR), CAST(5 + date_diff('day', snapshot_date, {_A}) AS INT), {DIMS},
       total_qty, done_qty, doing_qty, todo_qty, acc_qty FROM day_rows WHERE snapshot_date BETWEEN {_A} - 7 AND {_A}
""")
ctes.add("silver_files", f"""
SELECT DISTINCT c.* EXCLUDE (task_primary_date, task_create_date, ui_time_field, _mview_update_time, task_status, m),
       m AS file_month, CASE WHEN m = {month_key('task_start_date')} THEN 1 ELSE 0 END AS in_month_cohort
FROM (SELECT *, {month_key('task_start_date')} AS m FROM silver
      UNION ALL SELECT *, {month_key('task_claim_date')} FROM silver WHERE {month_key('task_claim_date')} < '{a.CUTOFF[:7]}'
      UNION ALL SELECT *, {month_key('task_end_date')} FROM silver WHERE {month_key('task_end_date')} < '{a.CUTOFF[:7]}') c
WHERE is_excluded = 0
""")


def months_for(spark, sf):
    return reports.file_months(labelled(spark, sf), a.CUTOFF)


def drills(spark, sf):
    """Every status of one day, stacked, each row with its place in the drill's order (one global sort, then its numbers)."""
    tasks = labelled(spark, sf)
    parts = [
        reports.audit_drill(tasks, DRILL_DAY, status).select(F.lit(status).alias("status"), "task_id").withColumn(
            "place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))
        for status in ("todo", "doing", "done", "all")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def filtered(spark, sf):
    return filter_dims(fact(spark, sf), region=["EUROPE", "AMERICA", "ASIA"], vx_type="V3", plant="ALL", line="")


CHECKS = [
    Check("anchor_date", anchors_per_region, ctes.sql(f"""
        SELECT 'all' AS pick, d AS anchor FROM anchor
        UNION ALL SELECT 'future', max(snapshot_date) FROM summary WHERE period_type = 'Day'
        UNION ALL SELECT 'until', max(snapshot_date) FROM summary
                  WHERE period_type = 'Day' AND snapshot_date <= DATE '1997-05-05'
        UNION ALL SELECT 'none', CAST(NULL AS DATE)""")),
    Check("periodic_report", report, ctes.sql("SELECT * FROM report")),
    Check("periodic_report_filtered", lambda s, d: report(s, d, vx_type="V1", factory="MAIN"), ctes.sql(
        "SELECT * FROM report WHERE vx_type = 'V1' AND factory = 'MAIN'")),
    Check("periodic_measures", lambda s, d: reports.periodic_measures(report(s, d)), ctes.sql(f"""
        SELECT *, total_qty AS effective_denominator, {_floor('todo_qty', 'total_qty')} AS todo_rate,
               {_floor('doing_qty', 'total_qty')} AS doing_rate, {_capped('done_qty', 'total_qty')} AS done_rate,
               {_capped('doing_done_qty', 'total_qty')} AS doing_done_rate,
               CASE WHEN granularity = 'Day' THEN {_capped('acc_qty', 'acc_total_qty')}
                    ELSE {_floor('(todo_qty + doing_qty)', 'total_qty')} END AS acc_rate
        FROM (SELECT granularity, period_name, {_SUMS}, max(sort_order) AS period_sort_order
              FROM report GROUP BY 1, 2)""")),
    Check("rollup_lattice", lattice_rows, ctes.sql(_lattice_sql())),
    Check("rollup_served_measures", served_measures, ctes.sql(" UNION ALL ".join([
        _served("whole", "''", "true"), _served("regions", "region", "vx_type = 'V1'"),
        _served("lines", "line", "vx_type = 'V3'")]))),
    Check("periodic_pivot", lambda s, d: reports.periodic_pivot(report(s, d)), ctes.sql("SELECT * FROM pivoted_report")),
    Check("pivot_measures", lambda s, d: reports.pivot_measures(reports.periodic_pivot(report(s, d))).withColumn(
        "task_pct", F.round("task_pct", 6)), ctes.sql("""
        SELECT granularity, period_name, status_name, CAST(sum(task_qty) AS BIGINT) AS task_qty,
               round(avg(task_pct), 6) AS task_pct, max(period_sort) AS period_sort_order
        FROM pivoted_report GROUP BY 1, 2, 3""")),
    Check("task_details", lambda s, d: rounded(reports.task_details(silver_fact(s, d))), ctes.sql(
        f"SELECT {', '.join(reports.DETAIL_COLUMNS)} FROM silver WHERE is_excluded = 0").replace(
        " duration_min, processing_time_min, assignee_code, assignee_name, l4_process_id, l4_process_name FROM silver",
        " round(duration_min, 6) AS duration_min, round(processing_time_min, 6) AS processing_time_min, assignee_code,"
        " assignee_name, l4_process_id, l4_process_name FROM silver")),
    Check("detail_measures", lambda s, d: reports.detail_measures(
        reports.task_details(silver_fact(s, d)), ["vx_type", "plant"]).withColumn(
        "avg_processing_time_min", F.round("avg_processing_time_min", 4)), ctes.sql("""
        SELECT vx_type, plant, count(DISTINCT task_id) AS task_count,
               round(avg(processing_time_min), 4) AS avg_processing_time_min
        FROM silver WHERE is_excluded = 0 GROUP BY 1, 2""")),
    Check("audit_drill_by_status", drills, ctes.sql(f"""
        SELECT status, task_id, CAST(row_number() OVER (PARTITION BY status
               ORDER BY task_end_time DESC NULLS LAST, task_start_time DESC NULLS LAST, task_id) AS INT) AS place
        FROM (SELECT lower(status_daily) AS status, * FROM counted WHERE task_start_date = DATE '{DRILL_DAY}'
              UNION ALL SELECT 'all', * FROM counted WHERE task_start_date = DATE '{DRILL_DAY}')""")),
    Check("status_on_day", lambda s, d: status_on_day(fact(s, d), F.col("task_start_date"), "todo").select("task_id"),
          ctes.sql("SELECT task_id FROM labelled WHERE status_daily = 'TODO'")),
    Check("monthly_report", monthly, ctes.sql("""
        SELECT period_type, label, 1 AS status_sort, 'Total Task' AS status, total_qty AS qty, '-' AS percentage FROM month_totals
        """ + "".join(f"""
        UNION ALL SELECT period_type, label, {i}, '{name}', {qty},
          CASE WHEN total_qty > 0 THEN printf('%.1f%%', {qty} * 100.0 / CAST(total_qty AS DOUBLE)) ELSE '-' END FROM month_totals"""
                      for i, (name, qty) in enumerate((("Todo", "todo_qty"), ("Doing", "doing_qty"), ("Done", "done_qty"),
                                                       ("Doing+Done", "doing_done_qty"), ("Todo+Doing(Acc)", "acc_qty")), start=2)))),
    Check("legacy_periodic_report", legacy, ctes.sql("SELECT * FROM legacy_rows")),
    Check("legacy_periodic_measures", lambda s, d: reports.legacy_periodic_measures(legacy(s, d)), ctes.sql(f"""
        SELECT *, todo_qty + doing_qty AS todo_doing_qty, doing_qty + done_qty AS doing_done_qty,
               round(done_qty * 100.0 / NULLIF(total_qty, 0), 2) AS done_rate,
               round(doing_qty * 100.0 / NULLIF(total_qty, 0), 2) AS doing_rate,
               round(todo_qty * 100.0 / NULLIF(total_qty, 0), 2) AS todo_rate,
               round((todo_qty + doing_qty) * 100.0 / NULLIF(total_qty, 0), 2) AS todo_doing_rate,
               round((doing_qty + done_qty) * 100.0 / NULLIF(total_qty, 0), 2) AS doing_done_rate
        FROM (SELECT period_name, sort_order, {_LEGACY_SUMS} FROM legacy_rows GROUP BY 1, 2)""")),
    Check("legacy_status_pivot", lambda s, d: reports.legacy_status_pivot(day_rows(s, d)), ctes.sql("\nUNION ALL\n".join(
        f"SELECT snapshot_date, {DIMS}, '{name}' AS status_name, {qty} AS task_qty, "
        + ("100.0" if i == 1 else f"round({qty} * 100.0 / NULLIF(total_qty, 0), 2)")
        + f" AS task_pct, {i} AS sort_order FROM day_rows" for i, (name, qty, _) in enumerate(_LINES, start=1)))),
    Check("trend_view", trend, ctes.sql(f"""
        SELECT snapshot_date AS "snapshotDate", vx_type AS "vxType", region, plant, factory, line,
               period_type AS "timePeriodType", period_key AS "periodKey", total_qty AS "totalTaskQty",
               todo_qty AS "todoQty", doing_qty AS "doingQty", done_qty AS "doneQty",
               todo_qty + doing_qty AS "inProgressQty", {_floor('done_qty', 'total_qty')} AS "completionRate",
               {_floor('(doing_qty + done_qty)', 'total_qty')} AS "executionRate",
               round(CASE WHEN total_qty > 0 THEN done_qty * 100.0 / total_qty ELSE 0 END, 6) AS "completionRateCalc",
               round(CASE WHEN total_qty > 0 THEN (doing_qty + done_qty) * 100.0 / total_qty ELSE 0 END, 6) AS "executionRateCalc"
        FROM summary""")),
    Check("dimension_values", lambda s, d: reports.dim_values(day_rows(s, d)), ctes.sql(
        f"SELECT DISTINCT {DIMS} FROM counted")),
    Check("composite_rates", composites, ctes.sql(f"""
        SELECT snapshot_date, {DIMS}, todo_qty + doing_qty AS todo_doing_qty, doing_qty + done_qty AS doing_done_qty,
               {_RATES6} FROM day_rows""")),
    Check("location_labels", lambda s, d: rollups.with_label_dimensions(fact(s, d).select(
        "task_id", "vx_type", "region", "plant", F.when(F.col("factory") != "MAIN", F.col("factory")).alias("factory"), "line")),
        ctes.sql("""
        SELECT task_id, vx_type, COALESCE(NULLIF(region, ''), 'UNKNOWN') AS region,
               COALESCE(NULLIF(plant, ''), 'UNKNOWN') AS plant,
               CASE WHEN factory = 'MAIN' THEN 'UNKNOWN' ELSE factory END AS factory, line,
               region || '-' || plant || '-' || CASE WHEN factory = 'MAIN' THEN 'UNKNOWN' ELSE factory END AS location_path
        FROM fact""")),
    Check("latest_backlog_then_sum", lambda s, d: rollups.latest_then_sum(
        day_rows(s, d).withColumn("month", F.date_format("snapshot_date", "yyyy-MM")), by=["month", "region"],
        within=["vx_type", "plant", "factory", "line"], order_col="snapshot_date", sums=["total_qty"], latest=["acc_qty"]),
        ctes.sql(f"""
        SELECT month, region, CAST(sum(t) AS BIGINT) AS total_qty, CAST(sum(acc) AS BIGINT) AS acc_qty FROM (
          SELECT {month_key('snapshot_date')} AS month, {DIMS}, sum(total_qty) AS t, arg_max(acc_qty, snapshot_date) AS acc
          FROM day_rows GROUP BY month, {DIMS}) GROUP BY 1, 2""")),
    Check("optional_dimension_filters", filtered, ctes.sql(
        "SELECT * FROM fact WHERE vx_type = 'V3' AND region IN ('EUROPE', 'AMERICA', 'ASIA')")),
    Check("month_touch_before_cutoff", lambda s, d: touching_month(fact(s, d), "1998-06", a.CUTOFF).select("task_id"),
          ctes.sql(f"""SELECT task_id FROM fact WHERE '1998-06' IN ({month_key('task_start_date')},
                   COALESCE({month_key('task_claim_date')}, ''), COALESCE({month_key('task_end_date')}, ''))""")),
    Check("month_touch_after_cutoff", lambda s, d: touching_month(fact(s, d), "2000-06", a.CUTOFF).select("task_id"),
          ctes.sql(f"SELECT task_id FROM fact WHERE {month_key('task_start_date')} = '2000-06'")),
    Check("file_months", months_for, ctes.sql("SELECT * EXCLUDE (m) FROM month_files")),
    Check("monthly_detail_export", lambda s, d: rounded(export.monthly_detail(silver_fact(s, d), a.CUTOFF)), ctes.sql("""
        SELECT * REPLACE (round(duration_min, 6) AS duration_min, round(processing_time_min, 6) AS processing_time_min)
        FROM silver_files""")),
    Check("month_detail_export", lambda s, d: rounded(export.month_detail(
        silver_fact(s, d), "1998-06", a.CUTOFF, region="")), ctes.sql("""
        SELECT * REPLACE (round(duration_min, 6) AS duration_min, round(processing_time_min, 6) AS processing_time_min)
        FROM silver_files WHERE file_month = '1998-06'""")),
    Check("month_export_preview", lambda s, d: export.export_preview(export.month_detail(
        silver_fact(s, d), "1998-06", a.CUTOFF)), ctes.sql("""
        SELECT vx_type, count(*) AS total_task, count(CASE WHEN status_monthly = 'TODO' THEN 1 END) AS todo,
               count(CASE WHEN status_monthly = 'DOING' THEN 1 END) AS doing,
               count(CASE WHEN status_monthly = 'DONE' THEN 1 END) AS done
        FROM silver_files WHERE file_month = '1998-06' AND in_month_cohort = 1 GROUP BY 1""")),
]
