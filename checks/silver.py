"""Bronze to silver checks: versions, variables, dimension, classification and the assembled task fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.operators import classify, dimensions, facts, filters, rollups, variables, versions
from cohortmill.operators.summary import day_summary
from cohortmill.operators.cohort import cohort_cells
from cohortmill.plans import daily
from checks import adapter as a
from checks.base import Check
from checks.oracle import ctes, week_start

LO, HI = "1998-01-01", "1998-07-01"

ctes.add("newest_task", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY PROC_INST_ID_, ID_ ORDER BY _sync_version DESC, _extracted_at DESC) AS rn
  FROM b_task) WHERE rn = 1
""")


def _newest(variable: str, value: str = "TEXT_") -> str:
    return (f"COALESCE((SELECT {value} FROM b_var v WHERE v.PROC_INST_ID_ = p.PROC_INST_ID_ AND NAME_ = '{variable}' "
            f"AND {value} IS NOT NULL AND REV_ IS NOT NULL ORDER BY REV_ DESC LIMIT 1), '') AS varinst_{variable}")


ctes.add("pivoted_all", "SELECT PROC_INST_ID_, " + ", ".join(_newest(v) for v in variables.TEXT_VARIABLES) + ", "
         + _newest("autoComplete", "CASE WHEN LONG_ = 1 THEN 'true' ELSE 'false' END")
         + " FROM (SELECT DISTINCT PROC_INST_ID_ FROM b_var) p")
ctes.add("pivoted", """
SELECT * FROM pivoted_all
WHERE varinst_plant <> '' OR varinst_region <> '' OR varinst_lineName <> '' OR varinst_moNumber <> ''
""")
ctes.add("levels", """
SELECT DISTINCT l.LINE_NAME AS line_name, l.LINE_DESC AS line_desc, COALESCE(ar.PROD_AREA_CODE, '') AS prod_area_code,
       COALESCE(pl.MFG_PLANT_CODE, '') AS factory_code, COALESCE(pl.MFG_PLANT_DESC, '') AS factory_name,
       COALESCE(pl.FACTORY, '') AS plant_code, COALESCE(pl.FACTORY, '') AS plant_name,
       COALESCE(fa.MFG_SITE, '') AS region_code, COALESCE(si.MFG_SITE_DESC, '') AS region_name
FROM m_line l LEFT JOIN m_area ar ON l.PROD_AREA_ID = ar.PROD_AREA_ID
     LEFT JOIN m_plant pl ON ar.MFG_PLANT_ID = pl.MFG_PLANT_ID
     LEFT JOIN m_factory fa ON ar.FACTORY = fa.FACTORY LEFT JOIN m_site si ON fa.MFG_SITE = si.MFG_SITE
WHERE l.LINE_NAME <> ''
""")
ctes.add("plant_region", """
SELECT plant_code, min(region_code) AS region_code FROM levels WHERE plant_code <> '' AND region_code <> ''
GROUP BY plant_code
""")
ctes.add("resolved", """
SELECT p.*,
  COALESCE(NULLIF(varinst_region, ''), NULLIF(m.region_code, ''), NULLIF(f.region_code, ''), '') AS region,
  COALESCE(NULLIF(varinst_plant, ''), NULLIF(m.plant_code, ''), '') AS plant,
  COALESCE(NULLIF(varinst_factory, ''), NULLIF(m.factory_code, ''), '') AS factory,
  COALESCE(NULLIF(varinst_lineName, ''), NULLIF(m.line_name, ''), '') AS line
FROM pivoted p
LEFT JOIN (SELECT line_name, plant_code, min(factory_code) AS factory_code, min(region_code) AS region_code
           FROM levels WHERE line_name <> '' AND plant_code <> '' GROUP BY 1, 2) m
  ON varinst_lineName = m.line_name AND varinst_plant = m.plant_code
LEFT JOIN plant_region f ON varinst_plant = f.plant_code
""")
ctes.add("auto_flags", """
SELECT TASK_ID_, max(CASE WHEN LONG_ = 1 THEN 1 ELSE 0 END) AS flag FROM b_var
WHERE NAME_ = 'autoComplete' AND TASK_ID_ <> '' GROUP BY TASK_ID_
""")
# Step 1, times: a 1970 time or day stands for "never".
ctes.add("silver_times", """
SELECT ID_ AS task_id, START_TIME_ AS opened_at, CAST(START_TIME_ AS DATE) AS opened,
       CASE WHEN CLAIM_TIME_ <> TIMESTAMP '1970-01-01' THEN CLAIM_TIME_ END AS claimed_at,
       CASE WHEN CAST(CLAIM_TIME_ AS DATE) > DATE '1970-01-01' THEN CAST(CLAIM_TIME_ AS DATE) END AS claimed,
       CASE WHEN END_TIME_ <> TIMESTAMP '1970-01-01' THEN END_TIME_ END AS ended_at,
       CASE WHEN CAST(END_TIME_ AS DATE) > DATE '1970-01-01' THEN CAST(END_TIME_ AS DATE) END AS ended
FROM newest_task
""")
# Step 2, statuses: what had happened by the last day of the opening day, week or month.
ctes.add("silver_horizons", f"""
SELECT task_id, grain, CASE WHEN ended BETWEEN opened AND horizon OR ended < opened AND grain <> 'daily' THEN 'DONE'
                            WHEN claimed BETWEEN opened AND horizon OR claimed < opened AND grain <> 'daily' THEN 'DOING'
                            ELSE 'TODO' END AS status
FROM (SELECT *, 'daily' AS grain, opened AS horizon FROM silver_times
      UNION ALL SELECT *, 'weekly', CAST({week_start('opened')} + 6 AS DATE) FROM silver_times
      UNION ALL SELECT *, 'monthly', last_day(opened) FROM silver_times)
""")
ctes.add("silver_statuses", "SELECT task_id, " + ", ".join(
    f"max(status) FILTER (grain = '{g}') AS status_{g}" for g in ("daily", "weekly", "monthly"))
    + " FROM silver_horizons GROUP BY task_id")
# Step 3, what the rules look at.
ctes.add("silver_traits", """
SELECT ID_ AS task_id, TASK_DEF_KEY_ AS node, NAME_ AS title, COALESCE(varinst_moNumber, '') AS order_no,
       COALESCE(factory, '') AS site, EmpName AS person, flag
FROM newest_task LEFT JOIN resolved USING (PROC_INST_ID_) LEFT JOIN b_emp ON ASSIGNEE_ = EmpCode
     LEFT JOIN auto_flags ON ID_ = TASK_ID_
""")
# Fixed values: (label, condition) in order of rank.
CLASS_RULES = (
    ("V1", "site = 'NPE' AND NOT starts_with(node, 'V2')"),
    ("V1", "left(order_no, 3) IN ('196', '199', '200', '210', '212', '213')"),
    ("V1", "starts_with(node, 'V1')"), ("V2", "starts_with(node, 'V2')"), ("V3", "starts_with(node, 'V3')"),
)
REASON_RULES = (
    ("bypass", "flag = 1"), ("system_bypass", "person = 'SYSTEM'"), ("system_node", "left(node, 1) IN ('E', 'C')"),
    ("Q_order", "left(order_no, 1) = 'Q'"), ("R_order", "left(order_no, 1) = 'R'"),
    ("notify_task", "contains(title, 'Notify')"), ("dummy_task", "contains(title, 'Dummy')"),
)


def _first_rule(rules) -> str:
    """Step 4: every rule that holds, as a row; the lowest rank counts."""
    hits = " UNION ALL ".join(
        f"SELECT task_id, {rank} AS place, '{label}' AS label FROM silver_traits WHERE {condition}"
        for rank, (label, condition) in enumerate(rules))
    return f"SELECT task_id, arg_min(label, place) AS label FROM ({hits}) GROUP BY task_id"


ctes.add("silver_classes", _first_rule(CLASS_RULES))
ctes.add("silver_reasons", _first_rule(REASON_RULES))
_BUSINESS = ", ".join(f"COALESCE(varinst_{variable}, '') AS {column}" for column, variable in facts.BUSINESS_COLUMNS.items())
ctes.add("silver_context", f"""
SELECT ID_ AS task_id, PROC_INST_ID_ AS proc_inst_id, COALESCE(BUSINESS_STATUS_, '') AS l4_process_id,
       COALESCE(b_def.NAME_, '') AS l4_process_name, COALESCE(varinst_time, '') AS ui_time_field,
       COALESCE(region, '') AS region, COALESCE(plant, '') AS plant, COALESCE(factory, '') AS factory,
       COALESCE(line, '') AS line, {_BUSINESS}, ASSIGNEE_ AS assignee_code
FROM newest_task LEFT JOIN resolved USING (PROC_INST_ID_)
     LEFT JOIN (SELECT ID_ AS proc, BUSINESS_STATUS_ FROM b_proc) ON PROC_INST_ID_ = proc
     LEFT JOIN (SELECT ID_ AS def, NAME_ FROM b_def) AS b_def ON PROC_DEF_ID_ = def
""")
ctes.add("silver_base", """
SELECT c.*, COALESCE(node, '') AS task_definition_key, COALESCE(title, '') AS task_name,
       opened_at AS task_start_time, claimed_at AS task_claim_time, ended_at AS task_end_time,
       opened AS task_start_date, claimed AS task_claim_date, ended AS task_end_date,
       opened AS task_primary_date, opened AS task_create_date,
       CASE WHEN ended IS NOT NULL THEN epoch(ended_at - opened_at) / 60.0 END AS duration_min,
       CASE WHEN ended IS NOT NULL AND claimed IS NOT NULL THEN epoch(ended_at - claimed_at) / 60.0 END AS processing_time_min,
       CASE WHEN ended IS NOT NULL THEN 'DONE' WHEN assignee_code <> '' THEN 'DOING' ELSE 'TODO' END AS task_status,
       status_daily, status_weekly, status_monthly,
       COALESCE(k.label, left(node, 2), 'Unknown') AS vx_type, COALESCE(r.label, '') AS reason,
       COALESCE(person, '') AS assignee_name
FROM silver_context c JOIN silver_traits USING (task_id) JOIN silver_times USING (task_id) JOIN silver_statuses USING (task_id)
     LEFT JOIN silver_classes k USING (task_id) LEFT JOIN silver_reasons r USING (task_id)
""")
ctes.add("silver_built", f"""
SELECT * EXCLUDE (reason), CASE WHEN reason <> '' THEN 1 ELSE 0 END AS is_excluded, reason AS exclude_reason,
       TIMESTAMP '{a.UPDATED_AT}' AS _mview_update_time FROM silver_base
""")
ctes.add("silver", """
SELECT * EXCLUDE (flagged) REPLACE (CASE WHEN flagged THEN 1 ELSE is_excluded END AS is_excluded,
                  CASE WHEN flagged THEN 'autoComplete_flag' ELSE exclude_reason END AS exclude_reason)
FROM (SELECT s.*, EXISTS (SELECT 1 FROM b_var WHERE NAME_ = 'autoComplete' AND LONG_ = 1 AND TASK_ID_ = s.task_id) AS flagged
      FROM silver_built s)
""")
_TOUCH = " OR ".join(f"({c} >= TIMESTAMP '{LO}' AND {c} < TIMESTAMP '{HI}')" for c in filters.TASK_TIMES)


def bronze(spark: SparkSession, sf: str) -> daily.Bronze:
    def get(sql):
        return a.derive(spark, sf, sql)

    return daily.Bronze(
        taskinst=get(a.BRONZE_TASKINST), varinst=get(a.BRONZE_VARINST), procinst=get(a.BRONZE_PROCINST),
        procdef=get(a.BRONZE_PROCDEF), employees=get(a.BRONZE_EMPLOYEES), line_desc=get(a.MDM_LINE_DESC),
        prod_area=get(a.MDM_PROD_AREA), mfg_plant=get(a.MDM_MFG_PLANT), factory_area=get(a.MDM_FACTORY_AREA),
        mfg_site=get(a.MDM_MFG_SITE),
    )


def silver_fact(spark: SparkSession, sf: str) -> DataFrame:
    return daily.task_fact(bronze(spark, sf), a.UPDATED_AT)


def newest_lines(spark, sf):
    line = a.table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in line.columns if c not in (*keys, "l_shipdate")]
    return versions.latest_by_key(line, keys, ["l_shipdate"], rest)


def newest_values(spark, sf):
    events = a.table(spark, sf, "events").select(
        "user_id", "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") > 10, F.col("value")).alias("value"),
    )
    return versions.argmax_by_key(events, ["user_id"], ["event_type", "value"], "event_id")


def event_pivot(spark, sf):
    """Newest value per user and event type, written as variable columns."""
    events = a.table(spark, sf, "events")
    kinds = ("click", "error", "purchase", "signup", "view")
    return events.groupBy("user_id").agg(*[
        versions.newest_value(F.col("value"), F.col("event_id"), F.col("event_type") == k).alias(f"last_{k}")
        for k in kinds
    ])


def classified(spark, sf):
    """Class, exclusion and reason straight from the rule functions, on the newest task rows."""
    b = bronze(spark, sf)
    tasks = versions.latest_by_key(b.taskinst, ["PROC_INST_ID_", "ID_"], facts.BRONZE_VERSION)
    pivot = dimensions.resolve_levels(variables.pivot_variables(b.varinst), daily.five_level(b))
    joined = tasks.join(pivot, "PROC_INST_ID_", "left").join(
        b.employees.select(F.col("EmpCode").alias("ASSIGNEE_"), "EmpName"), "ASSIGNEE_", "left"
    ).join(facts.auto_complete_flags(b.varinst).withColumnRenamed("TASK_ID_", "ID_"), "ID_", "left")
    order = F.coalesce("varinst_moNumber", F.lit(""))
    reason = classify.exclusion_reason(F.col("auto_complete"), F.col("EmpName"), F.col("TASK_DEF_KEY_"), order, F.col("NAME_"))
    return joined.select(
        F.col("ID_").alias("task_id"),
        classify.classify_vx(F.col("TASK_DEF_KEY_"), order, F.coalesce("factory", F.lit(""))).alias("vx_type"),
        classify.is_excluded(reason).alias("is_excluded"), reason.alias("exclude_reason"),
    )


def windowed_variables(spark, sf):
    b = bronze(spark, sf)
    active = filters.touching_window(
        b.taskinst, F.lit(LO).cast("timestamp_ntz"), F.lit(HI).cast("timestamp_ntz")
    ).select("PROC_INST_ID_")
    return variables.pivot_variables(b.varinst, active)


def touched(spark, sf):
    tasks = a.derive(spark, sf, a.BRONZE_TASKINST)
    return filters.touching_window(
        tasks, F.lit(LO).cast("timestamp_ntz"), F.lit(HI).cast("timestamp_ntz")
    ).select("ID_", "REV_", "START_TIME_", "CLAIM_TIME_", "END_TIME_")


def task_times(spark, sf):
    tasks = versions.latest_by_key(a.derive(spark, sf, a.BRONZE_TASKINST), ["PROC_INST_ID_", "ID_"], facts.BRONZE_VERSION)
    return facts.add_task_times(tasks).select(
        F.col("ID_").alias("task_id"), "task_start_time", "task_claim_time", "task_end_time", "task_start_date",
        "task_claim_date", "task_end_date", "task_primary_date", "task_create_date",
        F.round("duration_min", 6).alias("duration_min"), F.round("processing_time_min", 6).alias("processing_time_min"))


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("duration_min", "processing_time_min")})


_ROUND = "REPLACE (round(duration_min, 6) AS duration_min, round(processing_time_min, 6) AS processing_time_min)"

CHECKS = [
    Check("latest_version_rows", newest_lines, """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                   l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""),
    Check("newest_value_per_column", newest_values, """
        SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> 'error') AS event_type,
               arg_max(value, event_id) FILTER (value > 10) AS value FROM events GROUP BY user_id"""),
    Check("event_attribute_pivot", event_pivot, "SELECT user_id, " + ", ".join(
        f"arg_max(value, event_id) FILTER (event_type = '{k}') AS last_{k}"
        for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id"),
    Check("variable_pivot", lambda s, d: variables.pivot_variables(a.derive(s, d, a.BRONZE_VARINST)),
          ctes.sql("SELECT * FROM pivoted")),
    Check("variable_pivot_active_window", windowed_variables, ctes.sql(
        f"SELECT * FROM pivoted WHERE PROC_INST_ID_ IN (SELECT PROC_INST_ID_ FROM b_task WHERE {_TOUCH})")),
    Check("five_level_dimension", lambda s, d: daily.five_level(bronze(s, d)), ctes.sql("SELECT * FROM levels")),
    Check("first_region_per_plant", lambda s, d: dimensions.region_of_plant(daily.five_level(bronze(s, d))),
          ctes.sql("SELECT * FROM plant_region")),
    Check("level_resolution", lambda s, d: dimensions.resolve_levels(
        variables.pivot_variables(a.derive(s, d, a.BRONZE_VARINST)), daily.five_level(bronze(s, d))
    ).select("PROC_INST_ID_", "region", "plant", "factory", "line"),
        ctes.sql("SELECT PROC_INST_ID_, region, plant, factory, line FROM resolved")),
    Check("process_attributes", lambda s, d: facts.process_attributes(
        variables.pivot_variables(a.derive(s, d, a.BRONZE_VARINST)), daily.five_level(bronze(s, d)), bronze(s, d).procinst
    ), ctes.sql("""
        SELECT COALESCE(r.PROC_INST_ID_, p.ID_) AS PROC_INST_ID_, r.* EXCLUDE (PROC_INST_ID_), BUSINESS_STATUS_ AS l4_process_id
        FROM resolved r FULL JOIN b_proc p ON r.PROC_INST_ID_ = p.ID_""")),
    Check("touching_window", touched, ctes.sql(
        f"SELECT ID_, REV_, START_TIME_, CLAIM_TIME_, END_TIME_ FROM b_task WHERE {_TOUCH}")),
    Check("task_times_and_durations", task_times, ctes.sql("""
        SELECT task_id, task_start_time, task_claim_time, task_end_time, task_start_date, task_claim_date, task_end_date,
               task_primary_date, task_create_date, round(duration_min, 6) AS duration_min,
               round(processing_time_min, 6) AS processing_time_min FROM silver_base""")),
    Check("vx_class_and_exclusion", classified, ctes.sql(
        "SELECT task_id, vx_type, is_excluded, exclude_reason FROM silver_built")),
    Check("task_fact", lambda s, d: rounded(silver_fact(s, d)), ctes.sql(f"SELECT * {_ROUND} FROM silver")),
    Check("task_fact_in_window", lambda s, d: rounded(daily.task_fact(bronze(s, d), a.UPDATED_AT, LO, HI)), ctes.sql(
        f"SELECT * {_ROUND} FROM silver WHERE task_id IN (SELECT ID_ FROM b_task WHERE {_TOUCH})")),
    Check("exclusion_flag_update", lambda s, d: versions.apply_exclusion_flag(
        a.derive(s, d, a.TASK_FACT).select(F.concat(F.lit("T"), "task_id").alias("task_id"), "is_excluded",
                                           F.lit("").alias("exclude_reason")),
        a.derive(s, d, a.BRONZE_VARINST)), ctes.sql("""
        SELECT 'T' || task_id AS task_id, CASE WHEN f.TASK_ID_ IS NOT NULL THEN 1 ELSE is_excluded END AS is_excluded,
               CASE WHEN f.TASK_ID_ IS NOT NULL THEN 'autoComplete_flag' ELSE '' END AS exclude_reason
        FROM fact LEFT JOIN (SELECT DISTINCT TASK_ID_ FROM b_var WHERE NAME_ = 'autoComplete' AND LONG_ = 1) f
          ON 'T' || task_id = f.TASK_ID_""")),
    Check("exclusion_reasons", lambda s, d: silver_fact(s, d).groupBy("is_excluded", "exclude_reason", "vx_type").agg(
        F.count(F.lit(1)).alias("tasks")), ctes.sql(
        "SELECT is_excluded, exclude_reason, vx_type, count(*) AS tasks FROM silver GROUP BY 1, 2, 3")),
    Check("bronze_to_day_summary", lambda s, d: day_summary(cohort_cells(silver_fact(s, d))).groupBy("period_key").agg(
        *[F.sum(c).alias(c) for c in ("total_qty", "todo_qty", "doing_qty", "done_qty", "acc_qty", "acc_total_qty")]),
        ctes.sql("""
        SELECT CAST(d AS VARCHAR) AS period_key, count(CASE WHEN k = 0 THEN 1 END) AS total_qty,
               count(CASE WHEN k = 0 AND status_daily = 'TODO' THEN 1 END) AS todo_qty,
               count(CASE WHEN k = 0 AND status_daily = 'DOING' THEN 1 END) AS doing_qty,
               count(CASE WHEN k = 0 AND status_daily = 'DONE' THEN 1 END) AS done_qty,
               count(CASE WHEN task_end_date IS NULL OR task_end_date > d THEN 1 END) AS acc_qty,
               count(*) AS acc_total_qty
        FROM (SELECT *, CAST(task_start_date + CAST(k AS INT) AS DATE) AS d FROM silver, range(7) steps(k)
              WHERE is_excluded = 0) GROUP BY 1""")),
    Check("duplicate_keys", lambda s, d: versions.duplicate_keys(
        a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]), """
        SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""),
    Check("duplication_ratio", lambda s, d: versions.duplication_ratio(
        a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], F.date_format("l_shipdate", "yyyyMM")), """
        SELECT strftime(l_shipdate, '%Y%m') AS ym, count(*) AS raw_rows,
               count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
               round(count(*) / count(DISTINCT (l_orderkey, l_linenumber)), 4) AS ratio FROM lineitem GROUP BY 1"""),
    Check("distinct_tuples", lambda s, d: rollups.distinct_count(
        a.table(s, d, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_suppkey", "l_linenumber"]), """
        SELECT l_returnflag, count(DISTINCT (l_orderkey, l_suppkey, l_linenumber)) AS distinct_keys
        FROM lineitem GROUP BY 1"""),
    Check("data_span", lambda s, d: rollups.data_span(a.table(s, d, "events"), "ts"),
          "SELECT min(ts) AS min_time, max(ts) AS max_time, count(*) AS row_count FROM events"),
]
