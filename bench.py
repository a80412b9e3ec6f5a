"""Time the phases of the daily job, the reports and the audit; prints one JSON line.

The source tables are derived from the given tables. Tasks, variables and processes are copied ``BENCH_COPIES`` times
under new ids, which at sf0.1 gives the 1.5 million tasks behind the published numbers; the copies are stored before the
clock starts. The ingest is the package's own: month folders with lineage for logs, snapshots for the rest. Every phase then
reads stored tables, as it does in production. Phases and queries run to their last row (noop sink): once to warm up, then
``BENCH_RUNS`` times; the median counts. Whole jobs and the ingest run once. ``concurrent`` holds reports of ten threads in
one session: reports per second and median seconds; it is not part of the total.
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import adapter as a, gold, reporting, silver  # noqa: E402
from checks.registry import CHECKS  # noqa: E402
from cohortmill.operators import cohort, summary, variables, versions  # noqa: E402
from cohortmill.operators.facts import add_statuses, build_task_fact  # noqa: E402
from cohortmill.plans import daily, reports  # noqa: E402
from cohortmill.session import build_session, scratch_path  # noqa: E402
from cohortmill.sources import ingest  # noqa: E402
from cohortmill.sources.tables import read_snapshot  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
COPIES = int(os.environ.get("BENCH_COPIES", "10"))

LOGS = {"taskinst": "LAST_UPDATED_TIME_", "varinst": "CREATE_TIME_"}
LOADED_AT = "2003-01-01 00:00:00"
RECENT = ("2001-06-01", "2001-06-11")

# Registered queries timed as they are, on the given tables.
QUERIES = ("latest_version_rows", "duplication_ratio", "reconcile_counts", "missing_keys", "summary_across_cutoff",
           "event_attribute_pivot", "catchup_range")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        began = time.perf_counter()
        action()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times), 3)


def copied(df, *ids):
    """The rows ``COPIES`` times, each copy under its own ids, spread over the cores."""
    copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    return copies.withColumns({i: F.concat(i, F.lit("-"), "_copy") for i in ids}).drop("_copy").repartition(int(CPUS))


def concurrent(action, threads=10, each=3) -> dict:
    """``threads * each`` runs of an action from ``threads`` threads at a time."""
    def one(_):
        began = time.perf_counter()
        action()
        return time.perf_counter() - began

    began = time.perf_counter()
    with ThreadPoolExecutor(threads) as pool:
        times = list(pool.map(one, range(threads * each)))
    return {"per_second": round(len(times) / (time.perf_counter() - began), 2), "p50": round(statistics.median(times), 3)}


def once(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    spark = build_session("bench", CPUS, int(CPUS), **{"spark.driver.memory": "12g"})
    root = scratch_path(spark, "bench")
    seconds = {}

    def stored(name, df):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    derived = silver.bronze(spark, SF_DIR)
    derived = dataclasses.replace(
        derived, taskinst=copied(derived.taskinst, "ID_", "PROC_INST_ID_"), procinst=copied(derived.procinst, "ID_"),
        varinst=copied(derived.varinst, "PROC_INST_ID_", "TASK_ID_"))
    landed = {f.name: stored(f"landed_{f.name}", getattr(derived, f.name)) for f in dataclasses.fields(derived)}

    def loaded(name):
        """One table through the package's ingest."""
        path = f"{root}/{name}"
        if name in LOGS:
            ingest.ingest_batches_of(landed[name], path, LOGS[name], "1990-01-01", "2010-01-01", 30, LOADED_AT)
            return spark.read.parquet(path)
        ingest.ingest_full(landed[name], path, "bench", LOADED_AT)
        return read_snapshot(spark, path)

    tables = {}
    seconds["ingest_bronze"] = once(lambda: tables.update({name: loaded(name) for name in landed}))
    bronze = daily.Bronze(**tables)

    seconds["variable_pivot"] = timed(lambda: run(variables.pivot_variables(bronze.varinst)))
    pivot = stored("pivot", variables.pivot_variables(bronze.varinst))
    levels = stored("levels", daily.five_level(bronze))

    def fact():
        return build_task_fact(
            tasks=bronze.taskinst, pivot=pivot, five_level=levels, procinst=bronze.procinst, procdef=bronze.procdef,
            employees=bronze.employees, variables=bronze.varinst, updated_at=a.UPDATED_AT,
        )

    seconds["task_fact"] = timed(lambda: run(fact()))
    built = stored("built", fact())
    seconds["exclusion_update"] = timed(lambda: run(versions.apply_exclusion_flag(built, bronze.varinst)))
    seconds["bronze_to_fact_table"] = once(lambda: daily.write_fact(daily.task_fact(bronze, a.UPDATED_AT, levels=levels),
                                                                    f"{root}/fact"))

    fact_path, summary_path, context = f"{root}/job_fact", f"{root}/job_summary", (a.CUTOFF, a.AS_OF, a.UPDATED_AT)
    seconds["full_build"] = once(lambda: daily.full_build(bronze, fact_path, summary_path, *context))
    seconds["incremental_build_10_days"] = once(
        lambda: daily.incremental_build(bronze, fact_path, summary_path, *RECENT, *context))

    tasks = stored("tasks", copied(add_statuses(gold.fact(spark, SF_DIR), "assignee_code"), "task_id"))
    cells = cohort.cohort_cells(tasks)
    seconds["milestone"] = timed(lambda: run(cohort.milestone(cells)))
    seconds["backlog"] = timed(lambda: run(cohort.acc_rolling(cells)))
    seconds["completion"] = timed(lambda: run(cohort.completion_from_cells(cells)))
    seconds["summary"] = timed(lambda: run(summary.task_summary(tasks, a.CUTOFF, a.AS_OF)))
    seconds["summary_table"] = once(lambda: daily.write_summary(
        summary.task_summary(tasks, a.CUTOFF, a.AS_OF), f"{root}/summary"))

    kept = daily.read_summary(spark, f"{root}/summary")
    anchor = reports.anchor_date(kept, reporting.ANCHOR_AS_OF).first()["anchor"]
    report = reports.periodic_report(kept, anchor, vx_type="V1")
    seconds["report_measures"] = timed(lambda: run(reports.periodic_measures(report)))
    seconds["report_pivot"] = timed(lambda: run(reports.periodic_pivot(report)))
    seconds["monthly_report"] = timed(lambda: run(reports.monthly_report(kept, reporting.MONTH)))

    at_once = {
        "report_measures": concurrent(lambda: run(reports.periodic_measures(reports.periodic_report(kept, anchor, vx_type="V1")))),
        "monthly_report": concurrent(lambda: run(reports.monthly_report(kept, reporting.MONTH))),
    }

    checks = {check.name: check for check in CHECKS}
    for name in QUERIES:
        seconds[name] = timed(lambda name=name: run(checks[name].run(spark, SF_DIR)))

    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")), "tasks": tasks.count(),
        "variables": bronze.varinst.count(), "concurrent": at_once,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
