"""Checks of sources, sinks, incremental runs and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortmill.functions.values import null_if_epoch
from cohortmill.operators import rollups
from cohortmill.operators.filters import apply_retention
from cohortmill.operators.versions import latest_by_key
from cohortmill.plans import daily, reports, runs
from cohortmill.session import scratch_path
from cohortmill.sources import export, ingest, readers, tables
from cohortmill.sources.catalog import BATCH, FULL, SOURCE_TABLES, TableSpec
from cohortmill.streaming import changes
from checks import adapter as a
from checks.base import Check
from checks.gold import fact, labelled
from checks.oracle import SUMMARY_COLS, ctes, month_key, week_key, week_start

NOW = "2002-01-01 00:00:00"
ORDERS = TableSpec(
    "orders", "orders", BATCH,
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string", ("o_orderkey",), time_col="o_orderdate", step_days=30, history_start="1995-01-01",
)
ctes.add("marks", a.WATERMARKS)
ctes.add("runs_log", a.CHECKPOINTS)
ctes.add("newest_runs", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY phase, window_start, window_end
  ORDER BY update_time DESC) AS rn FROM runs_log) WHERE rn = 1
""")


def declared(spark, sf):
    return readers.read_source(spark, ORDERS, f"{sf}/orders.parquet")


def months_retired(spark, sf):
    path = scratch_path(spark, "retired")
    daily.write_fact(fact(spark, sf), path)
    daily.retire_months(spark, path, dt.date(2000, 6, 30))
    return daily.read_fact(spark, path).drop(daily.FACT_PARTITION)


def derived_flag(spark, sf):
    """The employee flag rule of the catalog, on task end times."""
    spec = SOURCE_TABLES["hr_employee"]
    people = a.derive(spark, sf, a.BRONZE_TASKINST).select(
        F.col("ID_").alias("EmpCode"), F.col("NAME_").alias("EmpName"), F.col("TASK_DEF_KEY_").alias("DeptCode"),
        F.col("END_TIME_").alias("TerminateDate"), F.col("START_TIME_").alias("ModifyDate"))
    return readers.apply_select_list(people, spec)


def snapshot_twice(spark, sf):
    """Load once, load again with other content, and read what is current."""
    root = scratch_path(spark, "customer")
    customer = a.table(spark, sf, "customer")
    ingest.ingest_full(customer.where("c_acctbal > 0"), root, "first", NOW)
    ingest.ingest_full(customer, root, "second", NOW)
    return tables.read_snapshot(spark, root)


def ranges(spark, sf):
    bounds = [(lo, lo + 10) for lo in range(0, 60, 10)]
    return readers.read_partitioned(a.table(spark, sf, "part"), "p_size", bounds)


def watermark_rows(spark, sf):
    out = None
    for table, col in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")):
        row = ingest.watermark_row(a.table(spark, sf, table), table, col, "2001-12-31 00:00:00", NOW, 12.5)
        out = row if out is None else out.unionByName(row)
    return out


def resume_points(spark, sf):
    marks = a.derive(spark, sf, a.WATERMARKS)
    marks = marks.withColumn("max_data_time", F.when(F.col("table_name") != "bpm_act_hi_procinst", F.col("max_data_time")))
    out = None
    for table, floor in (("bpm_act_hi_taskinst", None), ("bpm_act_hi_procinst", None), ("new_table", "2025-10-01"),
                         ("other_table", None)):
        row = ingest.resume_point(marks, table, floor).withColumn("table_name", F.lit(table))
        out = row if out is None else out.unionByName(row)
    return out


def month_folders(spark, sf):
    path = scratch_path(spark, "lineitem")
    lines = ingest.with_month_partition(a.table(spark, sf, "lineitem"), "l_shipdate")
    tables.overwrite_periods(lines, path, ["ym"])
    return spark.read.parquet(path).groupBy(F.col("ym").cast("string").alias("ym")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("l_shipdate").alias("first_ship"))


def two_batches(spark, sf):
    """The same batches appended window by window, one of them delivered twice; the newest version counts once."""
    path = scratch_path(spark, "orders")
    orders = a.table(spark, sf, "orders")
    for lo, hi in (("1990-01-01", "1998-01-01"), ("1998-01-01", "2010-01-01"), ("1998-01-01", "2010-01-01")):
        ingest.ingest_window(orders, path, "o_orderdate", lo, hi, NOW)
    log = spark.read.parquet(path)
    return latest_by_key(log, ["o_orderkey"], ["_sync_version", "_extracted_at"]).select(*orders.columns, "_batch_id")


def periods_overwritten(spark, sf):
    """All months written, then half of them written again: same table."""
    path = scratch_path(spark, "periods")
    orders = a.table(spark, sf, "orders").withColumn("ym", F.date_format("o_orderdate", "yyyyMM"))
    tables.overwrite_periods(orders, path, ["ym"])
    tables.overwrite_periods(orders.where(F.col("ym") >= "199801"), path, ["ym"])
    return spark.read.parquet(path).select(*orders.drop("ym").columns)


def exported_files(spark, sf):
    path = scratch_path(spark, "export")
    export.write_detail(reports.file_months(labelled(spark, sf), a.CUTOFF), path, ("file_month", "vx_type"))
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("file_month", "region", "plant", "vx_type").agg(F.count(F.lit(1)).alias("row_count")).fillna("")


def windows_with_tasks(spark, sf):
    """Each ETL window with the tasks opened in it."""
    tasks = fact(spark, sf)
    bounds = tasks.agg(F.min("task_start_date").alias("start_date"), F.max("task_start_date").alias("end_date"))
    windows = runs.etl_windows(bounds, step_days=10)
    days = windows.withColumn("task_start_date", F.explode(F.sequence(
        F.to_date("window_start"), F.date_sub(F.to_date("window_end"), 1), F.expr("INTERVAL '1' DAY"))))
    per_day = tasks.groupBy("task_start_date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "task_start_date").groupBy("window_start", "window_end").agg(F.sum("n").alias("tasks"))


def batches_with_rows(spark, sf):
    batches = runs.ingest_batches(spark, "1995-01-01", "2001-12-31", step_days=30)
    orders = a.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = batches.withColumn("day", F.explode(F.sequence(
        F.to_date("window_start"), F.date_sub(F.to_date("window_end"), 1), F.expr("INTERVAL '1' DAY"))))
    return days.join(orders, "day").groupBy("window_start", "window_end").agg(F.sum("n").alias("row_count"))


def catchup(spark, sf):
    return runs.catchup_range(a.derive(spark, sf, a.WATERMARKS), a.derive(spark, sf, a.CHECKPOINTS), as_of=a.AS_OF)


def pending(spark, sf):
    """Day windows of the event log that one phase has not finished, where the log has events."""
    events = a.table(spark, sf, "events")
    bounds = events.agg(F.to_date(F.min("ts")).alias("start_date"), F.date_add(F.to_date(F.max("ts")), 20).alias("end_date"))
    windows = runs.etl_windows(bounds, step_days=1)
    activity = events.where("event_type = 'error'").select(F.to_date("ts").alias("day"))
    return runs.pending_windows(windows, a.derive(spark, sf, a.CHECKPOINTS), "purchase", activity)


def affected(spark, sf):
    """Periods reached by the tasks of one process group: those with excluded customers."""
    return runs.affected_periods(fact(spark, sf).where("is_excluded = 1"), a.CUTOFF)


def status_checkpoints(spark, sf):
    report = runs.run_status(a.derive(spark, sf, a.WATERMARKS), a.derive(spark, sf, a.CHECKPOINTS),
                             {"events": a.table(spark, sf, "events")})
    return report["checkpoints"]


def status_watermarks(spark, sf):
    return ingest.latest_watermarks(a.derive(spark, sf, a.WATERMARKS))


def table_states(spark, sf):
    events = a.table(spark, sf, "events")
    per_table = events.groupBy("event_type", "user_id").agg(
        F.max(F.when(F.col("value") > 5, F.col("ts"))).alias("last_success"),
        F.count_if(F.col("value") > 15).alias("current_rows"),
    ).withColumn("strategy", F.when(F.col("event_type").isin("click", "view"), F.lit(FULL)).otherwise(F.lit(BATCH)))
    return runs.table_freshness(per_table, events.agg(F.max("ts")), 24)


def streamed(spark, sf):
    """Events through the change stream into a bronze log; read back once per event."""
    path, checkpoint = scratch_path(spark, "stream-log"), scratch_path(spark, "stream-checkpoint")
    schema = a.table(spark, sf, "events").schema
    stream = changes.change_stream(spark, sf, schema, pathGlobFilter="events.parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    changes.run_available(stream, checkpoint, changes.append_with_batch(path, ["event_id"], ["ts"]))
    log = spark.read.parquet(path)
    return latest_by_key(log, ["event_id"], ["ts"]).select("event_id", "user_id", "event_type", "value")


def incremental_summary(spark, sf):
    """First the tasks known early, then the rest arrives late and only affected periods are recomputed."""
    fact_path, summary_path = scratch_path(spark, "fact"), scratch_path(spark, "summary")
    whole = fact(spark, sf)
    early = whole.withColumn("task_end_date", F.when(F.col("task_end_date") < "1999-03-01", F.col("task_end_date"))
                             ).where(F.col("task_start_date") < "1999-03-01")
    daily.write_fact(early, fact_path)
    daily.write_summary(daily.summary_of(daily.read_fact(spark, fact_path), a.CUTOFF, a.AS_OF), summary_path)
    late = whole.where((F.col("task_start_date") >= "1999-03-01") | (F.col("task_end_date") >= "1999-03-01"))
    daily.apply_changes(spark, late, fact_path, summary_path, a.CUTOFF, a.AS_OF)
    return daily.read_summary(spark, summary_path).select(*SUMMARY_COLS.replace("\n", " ").replace(" ", "").split(","))


def functions(spark, sf):
    o = a.table(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey",
        F.concat(F.lpad(F.col("o_orderstatus"), 3, "0"), F.lit("/"), F.substring("o_orderpriority", 3, 4)).alias("text"),
        F.col("o_orderpriority").like("%LOW").alias("is_low"), F.col("o_orderpriority").ilike("%high%").alias("is_high"),
        (~F.col("o_orderpriority").startswith("1")).alias("not_first"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("F")), F.lit("-")).alias("status"),
        F.trunc(day, "week").alias("week_start"), F.trunc(day, "month").alias("month_start"), F.last_day(day).alias("month_end"),
        F.date_sub(day, 10).alias("before"), F.add_months(F.trunc(day, "month"), 1).alias("next_month"),
        F.date_diff(F.lit("2002-01-01").cast("date"), day).alias("age_days"),
        F.greatest(day, F.lit("1998-01-01").cast("date")).alias("not_before"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("thousands"),
        F.size(F.array_distinct(F.filter(F.array(day, F.last_day(day)), lambda d: d.isNotNull()))).alias("days"),
        null_if_epoch(F.when(F.col("o_orderstatus") == "O", F.lit("1970-01-01").cast("date")).otherwise(day)).alias("closed"),
        runs.readable_size((F.col("o_totalprice") * 100).cast("bigint")).alias("size"),
    )


def _windows_sql(start: str, stop: str, step: int) -> str:
    return (f"SELECT w AS window_start, least(w + INTERVAL '{step}' DAY, CAST({stop} AS TIMESTAMP)) AS window_end FROM "
            f"(SELECT unnest(generate_series(CAST({start} AS TIMESTAMP), CAST({stop} AS TIMESTAMP), INTERVAL '{step}' DAY)) AS w) "
            f"WHERE w < CAST({stop} AS TIMESTAMP)")


_SIZE = ("CASE WHEN b >= 1073741824 THEN printf('%.2f GiB', b / 1073741824.0) WHEN b >= 1048576 "
         "THEN printf('%.2f MiB', b / 1048576.0) WHEN b >= 1024 THEN printf('%.2f KiB', b / 1024.0) "
         "ELSE printf('%.2f B', b / 1.0) END")
_AFFECTED_OPEN = "SELECT DISTINCT task_start_date AS d FROM fact WHERE is_excluded = 1"

CHECKS = [
    Check("declared_source_scan", declared, "SELECT * FROM orders"),
    Check("ingest_derived_flag", derived_flag, ctes.sql("""
        SELECT ID_ AS "EmpCode", NAME_ AS "EmpName", TASK_DEF_KEY_ AS "DeptCode", START_TIME_ AS "ModifyDate",
               CASE WHEN END_TIME_ IS NULL OR END_TIME_ <= TIMESTAMP '1970-01-01' THEN 1 ELSE 0 END AS "IsActive"
        FROM b_task""")),
    Check("lineage_stamp", lambda s, d: ingest.with_lineage(a.table(s, d, "orders"), "batch_1", NOW), f"""
        SELECT *, 'batch_1' AS _batch_id, TIMESTAMP '{NOW}' AS _extracted_at, CAST(1 AS BIGINT) AS _sync_version FROM orders"""),
    Check("windowed_ingest", lambda s, d: ingest.in_window(a.table(s, d, "orders"), "o_orderdate", "1998-01-01", "1999-01-01"),
          "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'"),
    Check("bronze_append_log", two_batches, """
        SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '1990-01-01_1998-01-01'
                  ELSE '1998-01-01_2010-01-01' END AS _batch_id FROM orders"""),
    Check("snapshot_replace", snapshot_twice, f"""
        SELECT *, 'second' AS _batch_id, TIMESTAMP '{NOW}' AS _extracted_at, CAST(1 AS BIGINT) AS _sync_version FROM customer"""),
    Check("range_partitioned_read", ranges,
          "SELECT *, 'range_' || CAST(p_size // 10 + 1 AS VARCHAR) AS _batch_id FROM part WHERE p_size >= 0 AND p_size < 60"),
    Check("watermark_rows", watermark_rows, "\nUNION ALL\n".join(f"""
        SELECT '{t}' AS table_name, TIMESTAMP '2001-12-31' AS last_sync_time, TIMESTAMP '{NOW}' AS sync_time,
               count(*) AS row_count, CAST(12.5 AS DOUBLE) AS duration_ms, min({c}) AS min_data_time, max({c}) AS max_data_time
        FROM {t}""" for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")))),
    Check("resume_points", resume_points, ctes.sql("""
        SELECT 'bpm_act_hi_taskinst' AS table_name, arg_max(max_data_time, sync_time) AS resume_at FROM marks
        WHERE table_name = 'bpm_act_hi_taskinst'
        UNION ALL SELECT 'bpm_act_hi_procinst', arg_max(last_sync_time, sync_time) FROM marks WHERE table_name = 'bpm_act_hi_procinst'
        UNION ALL SELECT 'new_table', TIMESTAMP '2025-10-01' UNION ALL SELECT 'other_table', TIMESTAMP '2025-01-01'""")),
    Check("retention", lambda s, d: apply_retention(fact(s, d), "task_start_date", "2000-06-30", 1), ctes.sql(
        "SELECT * FROM fact WHERE task_start_date > DATE '1999-06-30'")),
    Check("retention_drop", months_retired, ctes.sql("SELECT * FROM fact WHERE task_start_date >= DATE '1999-06-01'")),
    Check("month_partition_layout", month_folders, """
        SELECT strftime(l_shipdate, '%Y%m') AS ym, count(*) AS row_count, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1"""),
    Check("period_overwrite_twice", periods_overwritten, "SELECT * FROM orders"),
    Check("export_files_read_back", exported_files, ctes.sql("""
        SELECT file_month, region, plant, vx_type, count(*) AS row_count FROM month_files GROUP BY 1, 2, 3, 4""")),
    Check("etl_windows", windows_with_tasks, ctes.sql(f"""
        SELECT window_start, window_end, count(*) AS tasks FROM fact JOIN (
          {_windows_sql("(SELECT min(task_start_date) FROM fact)", "(SELECT max(task_start_date) + 1 FROM fact)", 10)}
        ) w ON task_start_date >= window_start AND task_start_date < window_end GROUP BY 1, 2""")),
    Check("ingest_batches", batches_with_rows, f"""
        SELECT window_start, window_end, count(*) AS row_count FROM orders JOIN (
          {_windows_sql("DATE '1995-01-01'", "DATE '2002-01-01'", 30)}
        ) w ON o_orderdate >= window_start AND o_orderdate < window_end GROUP BY 1, 2"""),
    Check("catchup_range", catchup, ctes.sql("""
        SELECT CAST(least((SELECT max(window_end) FROM newest_runs WHERE phase = 'summary' AND status = 'SUCCESS'),
               (SELECT min(max_data_time) FROM marks WHERE table_name IN ('bpm_act_hi_taskinst', 'bpm_act_hi_varinst'))) AS DATE) - 1 AS start_date,
               CAST((SELECT max(last_sync_time) FROM marks WHERE table_name = 'bpm_act_hi_taskinst') AS DATE) AS end_date""")),
    Check("pending_windows", pending, ctes.sql("""
        SELECT DISTINCT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL '1' DAY AS window_end
        FROM events WHERE event_type = 'error' AND CAST(date_trunc('day', ts) AS TIMESTAMP) NOT IN (
          SELECT window_start FROM newest_runs WHERE phase = 'purchase' AND status = 'SUCCESS')""")),
    Check("affected_periods", affected, ctes.sql(f"""
        SELECT DISTINCT 'Day' AS period_type, CAST(x AS VARCHAR) AS period_key, x AS period_start FROM (
          SELECT CAST(d + CAST(k AS INT) AS DATE) AS x FROM ({_AFFECTED_OPEN}), range(7) s(k)
          UNION SELECT task_start_date FROM fact WHERE is_excluded = 1 AND task_start_date < DATE '{a.CUTOFF}'
          UNION SELECT task_claim_date FROM fact WHERE is_excluded = 1 AND task_claim_date < DATE '{a.CUTOFF}'
          UNION SELECT task_end_date FROM fact WHERE is_excluded = 1 AND task_end_date < DATE '{a.CUTOFF}')
        UNION ALL SELECT DISTINCT 'Week', {week_key('x')}, x FROM (
          SELECT {week_start('d')} AS x FROM ({_AFFECTED_OPEN}) UNION SELECT {week_start('(d + 6)')} FROM ({_AFFECTED_OPEN}))
        UNION ALL SELECT DISTINCT 'Month', {month_key('x')}, x FROM (
          SELECT CAST(date_trunc('month', d) AS DATE) AS x FROM ({_AFFECTED_OPEN})
          UNION SELECT CAST(date_trunc('month', d + 6) AS DATE) FROM ({_AFFECTED_OPEN}))""")),
    Check("run_status_checkpoints", status_checkpoints, ctes.sql(f"""
        SELECT phase, window_start, window_end, status, round(duration_ms / 1000, 2) AS duration_sec,
               {_SIZE.replace('b ', 'result_bytes ').replace('b >', 'result_bytes >')} AS size, result_rows AS rows, update_time
        FROM newest_runs ORDER BY update_time DESC, phase, window_start, window_end LIMIT 20""")),
    Check("run_status_watermarks", status_watermarks, ctes.sql("""
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY sync_time DESC) AS rn
        FROM marks) WHERE rn = 1""")),
    Check("table_freshness", table_states, """
        SELECT *, CASE WHEN strategy = 'full' AND current_rows = 0 THEN 'empty'
                       WHEN last_success IS NULL OR hours_since_success >= 24 THEN 'stale' ELSE 'ok' END AS status
        FROM (SELECT event_type, user_id, max(CASE WHEN value > 5 THEN ts END) AS last_success,
                     count(CASE WHEN value > 15 THEN 1 END) AS current_rows,
                     CASE WHEN event_type IN ('click', 'view') THEN 'full' ELSE 'batch' END AS strategy,
                     CAST(floor(date_diff('second', max(CASE WHEN value > 5 THEN ts END), (SELECT max(ts) FROM events)) / 3600) AS BIGINT)
                       AS hours_since_success
              FROM events GROUP BY event_type, user_id)"""),
    Check("failures_last_24h", lambda s, d: rollups.recent_events(
        a.table(s, d, "events"), "ts", a.table(s, d, "events").agg(F.max("ts")), 24, F.col("event_type") == "error"), """
        SELECT count(*) AS events FROM events WHERE event_type = 'error' AND ts >= (SELECT max(ts) FROM events) - INTERVAL '24' HOUR"""),
    Check("failures_per_hour", lambda s, d: rollups.events_per_period(
        a.table(s, d, "events"), "ts", "hour", F.col("event_type") == "error").withColumn(
        "time", F.col("time").cast("timestamp_ntz")), """
        SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, count(*) AS events FROM events
        WHERE event_type = 'error' GROUP BY 1"""),
    Check("event_rate_per_minute", lambda s, d: rollups.events_per_period(
        a.table(s, d, "events"), "ts", "minute", None, 60.0).withColumn("time", F.col("time").cast("timestamp_ntz")), """
        SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS time, count(*) AS events, count(*) / 60.0 AS rate
        FROM events GROUP BY 1"""),
    Check("recent_log_rows", lambda s, d: a.table(s, d, "events").where("event_type = 'error'").orderBy(
        F.col("ts").desc(), F.col("event_id").desc()).limit(200).select("event_id", "ts", "user_id"), """
        SELECT event_id, ts, user_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 200"""),
    Check("change_stream", streamed, "SELECT event_id, user_id, event_type, value FROM events"),
    Check("incremental_equals_full", incremental_summary, ctes.sql("SELECT * FROM summary")),
    Check("scalar_functions", functions, f"""
        SELECT o_orderkey, lpad(o_orderstatus, 3, '0') || '/' || substring(o_orderpriority, 3, 4) AS text,
          o_orderpriority LIKE '%LOW' AS is_low, o_orderpriority ILIKE '%high%' AS is_high,
          o_orderpriority NOT LIKE '1%' AS not_first, COALESCE(NULLIF(o_orderstatus, 'F'), '-') AS status,
          {week_start('o_orderdate')} AS week_start, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
          last_day(CAST(o_orderdate AS DATE)) AS month_end, CAST(o_orderdate AS DATE) - 10 AS before,
          CAST(date_trunc('month', o_orderdate) + INTERVAL '1' MONTH AS DATE) AS next_month,
          CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INT) AS age_days,
          greatest(CAST(o_orderdate AS DATE), DATE '1998-01-01') AS not_before,
          CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands,
          CASE WHEN CAST(o_orderdate AS DATE) = last_day(CAST(o_orderdate AS DATE)) THEN 1 ELSE 2 END AS days,
          CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS closed,
          {_SIZE.replace('b ', 'bytes ')} AS size
        FROM (SELECT *, CAST(trunc(o_totalprice * 100) AS BIGINT) AS bytes FROM orders)"""),
]
