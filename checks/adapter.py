"""Workflow-shaped inputs derived from the given tables.

Each shape is one SELECT in the dialect both engines share; ``{orders}`` and the like stand for the given tables.
Tasks come from orders, processes and their variables from customers, master data from nation, region and supplier.
Three plants hold most tasks (hot groups), the rest is spread over many plants, factories and lines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CUTOFF = "1999-01-01"
AS_OF = "2002-01-01"
UPDATED_AT = "2002-01-01 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages",
          "conversations", "labels", "benchmark", "embeddings")

_TIMES = """
    o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 600) AS t_start,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + INTERVAL '1' DAY * (o_orderkey % 9)
         + INTERVAL '1' MINUTE * (600 + o_orderkey % 300) END AS t_claim,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '1' DAY * (o_orderkey % 23)
         + INTERVAL '1' MINUTE * (900 + o_orderkey % 500) END AS t_end
"""

TASK_FACT = f"""
SELECT task_id, proc_inst_id, vx_type, region, plant, factory, line,
       t_start AS task_start_time, t_claim AS task_claim_time, t_end AS task_end_time,
       CAST(t_start AS DATE) AS task_start_date, CAST(t_claim AS DATE) AS task_claim_date,
       CAST(t_end AS DATE) AS task_end_date, assignee_code, is_excluded
FROM (
  SELECT CAST(o_orderkey AS STRING) AS task_id, CAST(o_custkey AS STRING) AS proc_inst_id,
         CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderpriority < '3' THEN 'V1' ELSE 'V3' END AS vx_type,
         r_name AS region, CASE WHEN n_regionkey < 3 THEN 'PLANT_' || r_name ELSE n_name END AS plant,
         CASE WHEN n_regionkey < 3 THEN 'MAIN' ELSE c_mktsegment END AS factory,
         CASE WHEN n_regionkey < 3 THEN '' ELSE 'L' || CAST(o_orderkey % 7 AS STRING) END AS line,
         {_TIMES},
         CASE WHEN o_orderkey % 4 <> 0 THEN 'E' || CAST(o_custkey % 150 AS STRING) ELSE '' END AS assignee_code,
         CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_excluded
  FROM {{orders}} o JOIN {{customer}} c ON o_custkey = c_custkey
       JOIN {{nation}} n ON c_nationkey = n_nationkey JOIN {{region}} r ON n_regionkey = r_regionkey
) shaped
"""

# Every order is logged once when opened and again once it was claimed or ended.
BRONZE_TASKINST = f"""
SELECT 'T' || CAST(o_orderkey AS STRING) AS ID_, rev AS REV_, 'PD' || CAST(o_custkey % 30 AS STRING) AS PROC_DEF_ID_,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'V1_URGENT' WHEN o_orderpriority = '2-HIGH' THEN 'V2_HIGH'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'V3_MEDIUM'
            WHEN o_orderpriority = '5-LOW' AND o_totalprice < 50000 THEN 'E_NODE'
            WHEN o_orderpriority = '5-LOW' AND o_totalprice < 90000 THEN NULL
            WHEN o_orderpriority = '5-LOW' THEN 'X9_LOW'
            WHEN o_totalprice < 50000 THEN 'C_NODE' ELSE 'V3_OTHER' END AS TASK_DEF_KEY_,
       'P' || CAST(o_custkey AS STRING) AS PROC_INST_ID_,
       CASE WHEN o_totalprice BETWEEN 60000 AND 75000 THEN 'Notify buyer'
            WHEN o_totalprice BETWEEN 75001 AND 90000 THEN 'Dummy step' ELSE 'Handle order' END AS NAME_,
       CASE WHEN rev = 2 AND t_claim IS NOT NULL THEN 'E' || CAST(o_custkey % 150 AS STRING) ELSE '' END AS ASSIGNEE_,
       t_start AS START_TIME_,
       CASE WHEN rev = 2 AND t_claim IS NOT NULL THEN t_claim ELSE TIMESTAMP_NTZ '1970-01-01 00:00:00' END AS CLAIM_TIME_,
       CASE WHEN rev = 2 AND t_end IS NOT NULL THEN t_end
            WHEN o_orderstatus = 'O' THEN TIMESTAMP_NTZ '1970-01-01 00:00:00' END AS END_TIME_,
       CASE WHEN rev = 1 THEN t_start WHEN t_end IS NOT NULL THEN t_end ELSE t_claim END AS LAST_UPDATED_TIME_,
       t_start + INTERVAL '1' DAY * (30 * rev) AS _extracted_at, CAST(1 AS BIGINT) AS _sync_version
FROM (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 1 AS rev, {_TIMES} FROM {{orders}} o1
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 2 AS rev, {_TIMES} FROM {{orders}} o2
  WHERE o_orderkey % 4 <> 0 OR o_orderstatus = 'F'
) versions
"""

_VARIABLE = """
  SELECT 'P' || CAST(c_custkey AS STRING) AS PROC_INST_ID_, CAST(NULL AS STRING) AS TASK_ID_, '{name}' AS NAME_,
         {text} AS TEXT_, {rev} AS REV_, CAST(NULL AS BIGINT) AS LONG_,
         TIMESTAMP_NTZ '1995-01-01 00:00:00' + INTERVAL '1' DAY * (c_custkey % 1000) AS CREATE_TIME_
  FROM {{customer}} c JOIN {{nation}} n ON c_nationkey = n_nationkey JOIN {{region}} r ON n_regionkey = r_regionkey
  WHERE {where}
"""


def _variable(name: str, text: str, rev: str = "1", where: str = "c_acctbal < 9000") -> str:
    return _VARIABLE.format(name=name, text=text, rev=rev, where=where)


BRONZE_VARINST = "\nUNION ALL\n".join([
    _variable("region", "'OLD'", "1", "c_acctbal BETWEEN 3000 AND 9000"),
    _variable("region", "r_name", "2", "c_acctbal BETWEEN 3000 AND 9000"),
    _variable("plant", "n_name", "1"),
    _variable("plant", "CAST(NULL AS STRING)", "2", "c_acctbal BETWEEN 5000 AND 9000"),
    _variable("factory", "CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END"),
    _variable("lineName", "'L' || CAST(c_custkey % 9 AS STRING)"),
    _variable("moNumber", "CASE WHEN c_acctbal < -500 THEN 'Q' WHEN c_acctbal < 0 THEN 'R' "
                          "WHEN c_acctbal < 700 THEN '199' ELSE '5' END || CAST(c_custkey AS STRING)"),
    _variable("modelName", "c_name", "3"),
    _variable("sapPlant", "'SP' || CAST(n_nationkey AS STRING)"),
    _variable("deliveryArea", "r_name", "CAST(NULL AS INT)"),
    _variable("unusedName", "c_name"),
    """
  SELECT 'P' || CAST(o_custkey AS STRING) AS PROC_INST_ID_, 'T' || CAST(o_orderkey AS STRING) AS TASK_ID_,
         'autoComplete' AS NAME_, CAST(NULL AS STRING) AS TEXT_, CAST(o_orderkey AS INT) AS REV_,
         CAST(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END AS BIGINT) AS LONG_, o_orderdate AS CREATE_TIME_
  FROM {orders} o WHERE o_totalprice > 350000
""",
])

BRONZE_PROCINST = """
SELECT 'P' || CAST(c_custkey AS STRING) AS ID_, c_mktsegment AS BUSINESS_STATUS_,
       TIMESTAMP_NTZ '1995-01-01 00:00:00' AS _extracted_at, CAST(1 AS BIGINT) AS _sync_version
FROM {customer} c
"""
BRONZE_PROCDEF = """
SELECT 'PD' || CAST(n_nationkey AS STRING) AS ID_, n_name AS NAME_,
       TIMESTAMP_NTZ '1995-01-01 00:00:00' AS _extracted_at, CAST(1 AS BIGINT) AS _sync_version
FROM {nation} n
"""
BRONZE_EMPLOYEES = """
SELECT 'E' || CAST(s_suppkey AS STRING) AS EmpCode, CASE WHEN s_acctbal < 0 THEN 'SYSTEM' ELSE s_name END AS EmpName,
       TIMESTAMP_NTZ '1995-01-01 00:00:00' AS _extracted_at, CAST(1 AS BIGINT) AS _sync_version
FROM {supplier} s
"""
MDM_LINE_DESC = """
SELECT 'L' || CAST(s_suppkey % 7 AS STRING) AS LINE_NAME, 'Line ' || CAST(s_suppkey % 7 AS STRING) AS LINE_DESC,
       'A' || CAST(s_nationkey AS STRING) AS PROD_AREA_ID
FROM {supplier} s
"""
MDM_PROD_AREA = """
SELECT 'A' || CAST(n_nationkey AS STRING) AS PROD_AREA_ID, 'AC' || CAST(n_nationkey AS STRING) AS PROD_AREA_CODE,
       'F' || CAST(n_regionkey AS STRING) AS FACTORY,
       CASE WHEN n_nationkey <> 24 THEN 'M' || CAST(n_nationkey AS STRING) END AS MFG_PLANT_ID
FROM {nation} n
"""
MDM_MFG_PLANT = """
SELECT 'M' || CAST(n_nationkey AS STRING) AS MFG_PLANT_ID,
       CASE WHEN n_regionkey = 0 THEN 'NPE' ELSE 'FC' || CAST(n_nationkey AS STRING) END AS MFG_PLANT_CODE,
       'Factory of ' || n_name AS MFG_PLANT_DESC, n_name AS FACTORY
FROM {nation} n
"""
MDM_FACTORY_AREA = """
SELECT 'F' || CAST(r_regionkey AS STRING) AS FACTORY, 'S' || CAST(r_regionkey AS STRING) AS MFG_SITE FROM {region} r
"""
MDM_MFG_SITE = """
SELECT 'S' || CAST(r_regionkey AS STRING) AS MFG_SITE, r_name AS MFG_SITE_DESC FROM {region} r
"""

# One watermark per ship month and return flag: each flag stands for a synced table.
WATERMARKS = """
SELECT CASE l_returnflag WHEN 'A' THEN 'bpm_act_hi_taskinst' WHEN 'N' THEN 'bpm_act_hi_varinst'
            ELSE 'bpm_act_hi_procinst' END AS table_name,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP_NTZ) + INTERVAL '32' DAY AS last_sync_time,
       CAST(date_trunc('month', l_shipdate) AS TIMESTAMP_NTZ) + INTERVAL '33' DAY AS sync_time,
       CAST(count(*) AS BIGINT) AS row_count, CAST(count(*) AS DOUBLE) AS duration_ms,
       min(l_shipdate) AS min_data_time, max(l_shipdate) AS max_data_time
FROM {lineitem} l GROUP BY 1, 2, 3
"""

# Each event is a finished run of a phase over one day.
CHECKPOINTS = """
SELECT CASE event_type WHEN 'click' THEN 'summary' WHEN 'view' THEN 'facts' WHEN 'error' THEN 'variables'
            ELSE event_type END AS phase,
       CAST(date_trunc('day', ts) AS TIMESTAMP_NTZ) AS window_start,
       CAST(date_trunc('day', ts) AS TIMESTAMP_NTZ) + INTERVAL '1' DAY AS window_end,
       CASE WHEN value < 5 THEN 'FAILED' ELSE 'SUCCESS' END AS status, '' AS error_msg,
       value * 1000 AS duration_ms, user_id AS result_rows, event_id * 1000 AS result_bytes, ts AS update_time
FROM {events} e
"""

_HOLES = re.compile(r"\{(\w+)\}")


def frames(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return frames(spark, sf_dir, name)[name]


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of the shapes above as a DataFrame."""
    return spark.sql(sql, **frames(spark, sf_dir, *sorted(set(_HOLES.findall(sql)))))


def duck(sql: str) -> str:
    """The same SELECT over the oracle's views."""
    return _HOLES.sub(r"\1", sql).replace("TIMESTAMP_NTZ", "TIMESTAMP").strip()
