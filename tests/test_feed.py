"""Rows that land late and replaced master data must reach the tasks they concern."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import adapter as a
from checks import daily_job
from cohortmill.operators.facts import FACT_COLUMNS
from cohortmill.plans import daily, feed, jobs
from cohortmill.session import scratch_path
from tests.test_daily import EPOCH, LINEAGE, bronze

SF = "/root/testdata/sf0.001"
MAY = [dt.datetime(2026, 5, d, 8) for d in range(1, 11)]
TASK = ("t1", 1, "d1", "V3_a", "p7", "Weld", "E1", MAY[0], EPOCH, EPOCH, 1, MAY[0])


def log(spark, *rows):
    """A bronze store with tasks of their own times and process rows (id, status, loaded at)."""
    base = bronze(spark, [TASK, (*TASK[:4], "p8", *TASK[5:])])
    tasks = base.taskinst.withColumn("LAST_UPDATED_TIME_", F.col("START_TIME_"))
    return dataclasses.replace(base, taskinst=tasks, procinst=spark.createDataFrame(
        [(key, status, 1, at) for key, status, at in rows], "ID_ string, BUSINESS_STATUS_ string" + LINEAGE))


def test_a_process_row_that_lands_late_reaches_its_task(spark):
    late = log(spark, ("p7", "B7", MAY[4]), ("p8", "B8", MAY[0]))
    found = daily.changed_tasks(late, MAY[3], MAY[7])
    assert [tuple(r) for r in found.collect()] == [("p7", "t1")]
    rows = daily.task_fact(late, MAY[8], only=found).collect()
    assert [(r.proc_inst_id, r.l4_process_id) for r in rows] == [("p7", "B7")]
    # By its own time, where the log has it, and only its month is opened.
    own_time = dataclasses.replace(late, procinst=late.procinst.withColumns({
        "START_TIME_": F.col("_extracted_at"), "_extracted_at": F.lit("2030-01-01").cast("timestamp_ntz")}))
    assert [tuple(r) for r in daily.changed_tasks(own_time, MAY[3], MAY[7]).collect()] == [("p7", "t1")]


def test_changed_keys_are_those_that_came_went_or_differ(spark):
    ddl = "plant_code string, line_name string, digest bigint"
    before = spark.createDataFrame([("A", "1", 1), ("A", "2", 1), ("B", "1", 1)], ddl)
    after = spark.createDataFrame([("A", "1", 1), ("A", "2", 2), ("C", "1", 1)], ddl)
    found = feed.changed_keys(before, after, feed.KEYS["lines"])
    assert sorted(map(tuple, found.collect())) == [("A", "2"), ("B", "1"), ("C", "1")]
    assert feed.changed_keys(before, before, feed.KEYS["lines"]).isEmpty()


def test_states_leave_out_blank_keys_and_old_versions(spark):
    base = bronze(spark, [TASK])
    people = spark.createDataFrame([("E1", "Ann", 1, MAY[0]), ("E1", "Bea", 2, MAY[1]), ("", "x", 1, MAY[0]), (None, "y", 1, MAY[0])],
                                   "EmpCode string, EmpName string" + LINEAGE)
    newest = people.where("EmpName = 'Bea'")
    levels = daily.five_level(base)
    found = feed.states(dataclasses.replace(base, employees=people), levels)["people"]
    only = feed.states(dataclasses.replace(base, employees=newest), levels)["people"]
    assert found.collect() == only.collect() and found.count() == 1


def test_master_data_alone_changes_the_tables_though_a_run_breaks_off(spark, monkeypatch):
    store, clock = jobs.Store(scratch_path(spark, "feed-store")), daily_job.ticking()

    def run(until, first):
        sources = {name: (lambda name=name: daily_job.landed(spark, SF, name, first)) for name in daily_job.SHAPES}
        return jobs.run_daily(spark, sources, store, until=until, cutoff=a.CUTOFF, as_of=a.AS_OF, updated_at=a.UPDATED_AT, now=clock,
                              start="1992-01-01", step_days=4000, specs=daily_job.SPECS)

    def stored():
        return daily.read_fact(spark, store.path("fact")).select(*FACT_COLUMNS)

    def fails(*_, **__):
        raise RuntimeError("lost")

    run("2003-01-01 00:00:00", True)
    before = stored().collect()
    assert not jobs.open_feeds(spark, store, daily_job.SPECS)
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "take_over", fails)
        with pytest.raises(RuntimeError, match="lost"):
            run("2003-01-02 00:00:00", False)
    assert set(jobs.open_feeds(spark, store, daily_job.SPECS)) == set(jobs.FEEDS)
    run("2003-01-02 00:00:00", False)
    bronze_now = jobs.read_bronze(spark, store, daily_job.SPECS)
    whole = daily.task_fact(bronze_now, a.UPDATED_AT, levels=daily.five_level(bronze_now)).select(*FACT_COLUMNS)
    assert sorted(map(str, stored().collect())) == sorted(map(str, whole.collect())) != sorted(map(str, before))
    total = daily.read_summary(spark, store.path("summary")).drop("period_month")
    expected = daily.summary_of(daily.read_fact(spark, store.path("fact")), a.CUTOFF, a.AS_OF).select(*total.columns)
    assert total.exceptAll(expected).isEmpty() and expected.exceptAll(total).isEmpty()
    assert not jobs.open_feeds(spark, store, daily_job.SPECS)
    assert daily.open_partitions(spark, store.path("summary")).isEmpty()
