"""The daily job from landed sources to summary, run several times, against one pass over everything."""

from __future__ import annotations

import dataclasses
import datetime as dt
import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.operators.facts import FACT_COLUMNS
from cohortmill.plans import daily, jobs, recon
from cohortmill.plans.runs import PHASES
from cohortmill.session import scratch_path
from cohortmill.sources.catalog import BATCH, SOURCE_TABLES
from cohortmill.sources.readers import apply_select_list
from checks import adapter as a
from checks.base import Check
from checks.oracle import SUMMARY_COLS, ctes
from checks.silver import _ROUND, rounded

# Loads end here: the first brings most rows, the last is repeated.
LOADS = ("1998-03-15 12:00:00", "2003-01-01 00:00:00", "2003-01-01 00:00:00")
SHAPES = {
    "taskinst": a.BRONZE_TASKINST, "varinst": a.BRONZE_VARINST, "procinst": a.BRONZE_PROCINST,
    "procdef": a.BRONZE_PROCDEF, "hr_employee": a.BRONZE_EMPLOYEES, "mdm_line_desc": a.MDM_LINE_DESC,
    "mdm_prod_area": a.MDM_PROD_AREA, "mdm_mfg_plant": a.MDM_MFG_PLANT, "mdm_factory_area": a.MDM_FACTORY_AREA,
    "mdm_mfg_site": a.MDM_MFG_SITE,
}
SPECS = {
    name: dataclasses.replace(SOURCE_TABLES[name], history_start="1990-01-01", step_days=30)
    if SOURCE_TABLES[name].strategy == BATCH else SOURCE_TABLES[name] for name in SHAPES
}


# Process rows that land long after the tasks of their process.
_LATE = "TIMESTAMP '2002-06-01 00:00:00'"
_PROC_TIME = f"CASE WHEN ID_ LIKE '%3' THEN {_LATE} ELSE _extracted_at END"
# What the first load saw in tables that are loaded whole: renamed people and definitions, a factory of another site.
_BEFORE = {
    "hr_employee": ("EmpName", "CASE WHEN EmpCode LIKE '%5' THEN 'SYSTEM' ELSE EmpName END"),
    "procdef": ("NAME_", "CASE WHEN ID_ IN ('PD3', 'PD7') THEN 'Old name' ELSE NAME_ END"),
    "mdm_factory_area": ("MFG_SITE", "CASE WHEN FACTORY = 'F1' THEN 'S9' ELSE MFG_SITE END"),
}


def landed(spark: SparkSession, sf: str, name: str, first: bool = False) -> DataFrame:
    """A source table in its declared layout, as the ``first`` load or a later one finds it; columns the shape does not fill
    are NULL."""
    shape = a.derive(spark, sf, SHAPES[name])
    if name == "procinst":
        shape = shape.withColumn("START_TIME_", F.expr(_PROC_TIME).cast("timestamp_ntz"))
    if first and name in _BEFORE:
        column, rule = _BEFORE[name]
        shape = shape.withColumn(column, F.expr(rule))
    return shape.select(*[
        (F.col(f.name) if f.name in shape.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SPECS[name].schema.fields
    ])


def ticking() -> jobs.Clock:
    seconds = itertools.count()
    return lambda: dt.datetime(2003, 1, 2) + dt.timedelta(seconds=next(seconds))


_STORES: dict[tuple[str, str, int], jobs.Store] = {}


def store_after_loads(spark: SparkSession, sf: str, step_days: int = 2000) -> jobs.Store:
    """Three runs of the daily job: one from the beginning, one that catches up with late process rows and changed master
    data, one that finds nothing to do. Checks of one session look at the same store."""
    key = spark.sparkContext.applicationId, sf, step_days
    if key in _STORES:
        return _STORES[key]
    store, clock = jobs.Store(scratch_path(spark, "store")), ticking()
    for number, until in enumerate(LOADS):
        sources = {name: (lambda name=name, first=not number: landed(spark, sf, name, first)) for name in SHAPES}
        jobs.run_daily(spark, sources, store, until=until, cutoff=a.CUTOFF, as_of=a.AS_OF, updated_at=a.UPDATED_AT,
                       now=clock, start=None if number else "1992-01-01", step_days=step_days, specs=SPECS)
    _STORES[key] = store
    return store


def job_fact(spark, sf):
    store = store_after_loads(spark, sf)
    return rounded(daily.read_fact(spark, store.path("fact")).select(*FACT_COLUMNS))


def job_summary(spark, sf):
    store = store_after_loads(spark, sf)
    return daily.read_summary(spark, store.path("summary")).select(*[c.strip() for c in SUMMARY_COLS.split(",")])


def job_log(spark, sf):
    """Watermarks of the batch tables and checkpoints, one window per run; the run without input adds none."""
    store = store_after_loads(spark, sf, 4000)
    batch = [spec.target for spec in SPECS.values() if spec.strategy == BATCH]
    loads = jobs.watermarks(spark, store).where(F.col("table_name").isin(batch)).select(
        F.col("table_name").alias("name"), F.col("last_sync_time").alias("reached"), F.lit("LOADED").alias("status"),
        F.col("max_data_time").alias("newest"))
    phases = jobs.checkpoints(spark, store).select(
        F.col("phase").alias("name"), F.col("window_end").alias("reached"), "status",
        F.lit(None).cast("timestamp_ntz").alias("newest"))
    return loads.unionByName(phases)


def audited(spark, sf):
    """The audit of all tables after a load that left out some tasks."""
    def partly(name):
        return landed(spark, sf, name).where(~F.col("ID_").endswith("77")) if name == "taskinst" else landed(spark, sf, name)

    pairs = {name: tuple(apply_select_list(x, SPECS[name]) for x in (landed(spark, sf, name), partly(name))) for name in SHAPES}
    verdicts = recon.audit_catalog(pairs, SPECS, cutoff="2002-01-01", days=4000)
    gaps = recon.catalog_gaps(verdicts, pairs, SPECS, cutoff="2002-01-01", days=4000)
    missing = None
    for name, keys in gaps.items():
        row = keys.select(F.lit(name).alias("table"), F.concat_ws("|", *SPECS[name].keys).alias("key"), "src_rows")
        missing = row if missing is None else missing.unionByName(row)
    return missing


# The summary's rules, read from the fact that bronze gives.
_BRONZE_PARTS = [n for n in ctes.names if n.startswith(("b_", "m_", "silver")) or n in (
    "newest_task", "pivoted_all", "pivoted", "levels", "plant_region", "resolved", "auto_flags")]
built = ctes.rebased(_BRONZE_PARTS, fact="""
SELECT task_id, proc_inst_id, vx_type, region, plant, factory, line, task_start_date, task_claim_date, task_end_date,
       assignee_code, is_excluded FROM silver
""")
_LOADED = "\nUNION ALL\n".join(
    f"SELECT '{SPECS[n].target}' AS name, TIMESTAMP '{until}' AS reached, 'LOADED' AS status, max({c}) AS newest "
    f"FROM {t} WHERE {c} >= COALESCE((SELECT max({c}) FROM {t} WHERE {c} < TIMESTAMP '{before}'), TIMESTAMP '{before}') "
    f"AND {c} < TIMESTAMP '{until}'"
    for n, t, c in (("taskinst", "b_task", "LAST_UPDATED_TIME_"), ("varinst", "b_var", "CREATE_TIME_"),
                    ("procinst", "b_proc", f"({_PROC_TIME})"))
    for before, until in zip(("1990-01-01", *LOADS), LOADS[:-1])
)

CHECKS = [
    Check("daily_job_fact", job_fact, ctes.sql(f"SELECT * {_ROUND} FROM silver")),
    Check("daily_job_summary", job_summary, built.sql("SELECT * FROM summary")),
    Check("daily_job_log", job_log, ctes.sql(_LOADED + "".join(
        f" UNION ALL SELECT '{phase}', TIMESTAMP '{until}', 'SUCCESS', CAST(NULL AS TIMESTAMP)"
        for phase in PHASES for until in LOADS[:-1]))),
    Check("catalog_audit_gaps", audited, ctes.sql("""
        SELECT 'taskinst' AS "table", PROC_INST_ID_ || '|' || ID_ AS key, count(*) AS src_rows FROM b_task
        WHERE ID_ LIKE '%77' GROUP BY 1, 2""")),
]
