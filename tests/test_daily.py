"""Incremental runs must leave the tables one full build would."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.operators.summary import SUMMARY_COLUMNS
from cohortmill.plans import daily
from cohortmill.streaming import changes
from tests.conftest import day
from tests.test_summary import frame, random_tasks

AS_OF = "2026-04-01"


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*SUMMARY_COLUMNS).collect())


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "fact"), str(tmp_path / "summary")


def build(spark, tasks, paths, cutoff):
    daily.write_fact(tasks, paths[0])
    daily.write_summary(daily.summary_of(daily.read_fact(spark, paths[0]), cutoff, AS_OF), paths[1])


@pytest.mark.parametrize("cutoff", ["2026-01-01", "2025-12-01", "2026-03-01"])
def test_late_events_heal_old_cohorts(spark, make_tasks, paths, cutoff):
    final = random_tasks(21, n=90)
    split = dt.date(2026, 1, 5)
    early = [(t[0], t[1], t[2] if t[2] and t[2] < split else None, t[3] if t[3] and t[3] < split else None, t[4], t[5])
             for t in final if t[1] < split]
    changed = [t for t in final if t[1] >= split or (t[2] and t[2] >= split) or (t[3] and t[3] >= split)]
    build(spark, frame(make_tasks, early), paths, cutoff)
    daily.apply_changes(spark, frame(make_tasks, changed), *paths, cutoff, AS_OF)
    expected = rows(daily.summary_of(frame(make_tasks, final), cutoff, AS_OF))
    assert rows(daily.read_summary(spark, paths[1])) == expected
    daily.apply_changes(spark, frame(make_tasks, changed), *paths, cutoff, AS_OF)  # the same run once more
    assert rows(daily.read_summary(spark, paths[1])) == expected


def test_streamed_changes_keep_the_summary_current(spark, make_tasks, paths, tmp_path):
    final = random_tasks(33, n=40)
    split = dt.date(2026, 1, 5)
    opened = [(t[0], t[1], None, None, t[4], t[5]) for t in final if t[1] < split]
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for version, tasks in enumerate((opened, final)):
        frame(make_tasks, tasks).withColumn("v", F.lit(version)).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        changes.run_available(changes.change_stream(spark, landing, schema), checkpoint,
                              changes.refresh_with_batch(*paths, "2026-01-01", AS_OF, ["v"]))
    expected = rows(daily.summary_of(frame(make_tasks, final), "2026-01-01", AS_OF))
    assert rows(daily.read_summary(spark, paths[1])) == expected


def test_moved_and_excluded_tasks_leave_no_old_rows(spark, make_tasks, paths):
    before = make_tasks(("a", "2026-02-20", None, None, "P1"), ("b", "2026-05-03", None, None, "P1"))
    build(spark, before, paths, "2026-01-01")
    after = make_tasks(("a", "2026-02-20", None, None, "P2"), ("b", "2026-05-03", None, None, "P1", 1))
    daily.apply_changes(spark, after, *paths, "2026-01-01", AS_OF)
    kept = daily.read_summary(spark, paths[1])
    assert rows(kept) == rows(daily.summary_of(after, "2026-01-01", AS_OF))
    assert {r.plant for r in kept.select("plant").distinct().collect()} == {"P2"}
    assert daily.read_fact(spark, paths[0]).count() == 2


def test_an_update_reads_only_the_months_it_needs(spark, make_tasks, paths):
    tasks = make_tasks(*[(f"t{m}", f"2026-{m:02d}-10", None, None) for m in range(1, 10)])
    daily.write_fact(tasks, paths[0])
    fact = daily.read_fact(spark, paths[0])
    parts = spark.createDataFrame([("Day", "202605")], "period_type string, period_month string")
    needed = daily._needed_tasks(fact, parts, "2026-01-01")
    assert sorted(r.task_id for r in needed.collect()) == ["t4", "t5", "t6"]
    plan = needed._jdf.queryExecution().executedPlan().toString()
    assert "start_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


TASK = ("ID_ string, REV_ int, PROC_DEF_ID_ string, TASK_DEF_KEY_ string, PROC_INST_ID_ string, NAME_ string, "
        "ASSIGNEE_ string, START_TIME_ timestamp_ntz, CLAIM_TIME_ timestamp_ntz, END_TIME_ timestamp_ntz, "
        "_sync_version bigint, _extracted_at timestamp_ntz")
LINEAGE = ", _sync_version bigint, _extracted_at timestamp_ntz"
T0, EPOCH = dt.datetime(2026, 2, 2, 8), dt.datetime(1970, 1, 1)


def bronze(spark, tasks):
    def make(rows_, ddl):
        return spark.createDataFrame(rows_, ddl)

    return daily.Bronze(
        taskinst=make(tasks, TASK),
        varinst=make([("p1", None, "plant", "PA", 1, None, T0), ("p1", None, "lineName", "L1", 1, None, T0),
                      ("p2", "t2", "autoComplete", None, 1, 1, T0), ("p2", None, "moNumber", "Q7", 1, None, T0)],
                     "PROC_INST_ID_ string, TASK_ID_ string, NAME_ string, TEXT_ string, REV_ int, LONG_ bigint, CREATE_TIME_ timestamp_ntz"),
        procinst=make([("p1", "L4-1", 1, T0), ("p1", "L4-1", 1, T0)], "ID_ string, BUSINESS_STATUS_ string" + LINEAGE),
        procdef=make([("d1", "Assembly", 1, T0)], "ID_ string, NAME_ string" + LINEAGE),
        employees=make([("E1", "Ann", 1, T0), ("E1", "Ann", 1, T0), ("E2", "SYSTEM", 1, T0)], "EmpCode string, EmpName string" + LINEAGE),
        line_desc=make([("L1", "Line 1", "A1"), ("", "none", "A1")], "LINE_NAME string, LINE_DESC string, PROD_AREA_ID string"),
        prod_area=make([("A1", "AC1", "F1", "M1")], "PROD_AREA_ID string, PROD_AREA_CODE string, FACTORY string, MFG_PLANT_ID string"),
        mfg_plant=make([("M1", "NPE", "Plant", "PA")], "MFG_PLANT_ID string, MFG_PLANT_CODE string, MFG_PLANT_DESC string, FACTORY string"),
        factory_area=make([("F1", "S1")], "FACTORY string, MFG_SITE string"),
        mfg_site=make([("S1", "Site 1")], "MFG_SITE string, MFG_SITE_DESC string"),
    )


def test_bronze_to_fact(spark):
    end = dt.datetime(2026, 2, 2, 9, 30)
    tasks = [
        ("t1", 1, "d1", "V3_a", "p1", "Weld", "", T0, EPOCH, EPOCH, 1, T0),
        ("t1", 2, "d1", "V3_a", "p1", "Weld", "E1", T0, dt.datetime(2026, 2, 2, 9), end, 1, end),
        ("t2", 1, None, "V2_b", "p2", "Pack", None, T0, EPOCH, None, 1, T0),
        ("t3", 1, "d9", None, "p9", None, "E2", T0, EPOCH, EPOCH, 1, T0),
        ("", 1, "d1", "V1_a", "p1", "x", "E1", T0, EPOCH, EPOCH, 1, T0)]
    fact = {r.task_id: r for r in daily.task_fact(bronze(spark, tasks), "2026-02-03 00:00:00").collect()}
    assert sorted(fact) == ["t1", "t2", "t3"]
    one, two, three = fact["t1"], fact["t2"], fact["t3"]
    assert (one.region, one.plant, one.factory, one.line, one.vx_type) == ("S1", "PA", "NPE", "L1", "V1")
    assert (one.duration_min, one.processing_time_min, one.task_status, one.status_daily) == (90.0, 30.0, "DONE", "DONE")
    assert (one.l4_process_id, one.l4_process_name, one.assignee_name, one.is_excluded) == ("L4-1", "Assembly", "Ann", 0)
    assert (two.task_claim_time, two.task_end_date, two.duration_min) == (None, None, None)
    assert (two.is_excluded, two.exclude_reason, two.mo_number, two.assignee_code) == (1, "autoComplete_flag", "Q7", "")
    assert (three.vx_type, three.exclude_reason, three.region, three.task_status) == ("Unknown", "system_bypass", "", "DOING")


def test_full_and_incremental_builds_from_bronze_agree(spark, tmp_path):
    opened = ("t1", 1, "d1", "V3_a", "p1", "Weld", "", T0, EPOCH, EPOCH, 1, T0)
    end = dt.datetime(2026, 3, 3, 9)
    ended = ("t1", 2, "d1", "V3_a", "p1", "Weld", "E1", T0, end, end, 1, end)
    other = ("t4", 1, "d1", "V2_a", "p1", "Weld", "E1", dt.datetime(2026, 3, 1, 8), EPOCH, EPOCH, 1, end)
    fact, summary_ = str(tmp_path / "f"), str(tmp_path / "s")
    daily.full_build(bronze(spark, [opened]), fact, summary_, "2026-01-01", AS_OF, T0)
    daily.incremental_build(bronze(spark, [opened, ended, other]), fact, summary_, "2026-03-01", "2026-03-04", "2026-01-01", AS_OF, T0)
    full_fact, full_summary = str(tmp_path / "f2"), str(tmp_path / "s2")
    daily.full_build(bronze(spark, [opened, ended, other]), full_fact, full_summary, "2026-01-01", AS_OF, T0)
    assert rows(daily.read_summary(spark, summary_)) == rows(daily.read_summary(spark, full_summary))
    columns = ["task_id", "task_status", "status_monthly", "task_end_date", *DIMENSIONS]
    got = daily.read_fact(spark, fact).select(*columns)
    want = daily.read_fact(spark, full_fact).select(*columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 2
    assert day("2026-03-03") in {r.task_end_date for r in got.collect()}
