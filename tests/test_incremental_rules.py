"""Runs out of order, repeated, late or broken off must end with the tables of one full build."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.plans import daily, runs
from cohortmill.session import shared_dir
from cohortmill.streaming import changes
from tests.conftest import day
from tests.test_daily import AS_OF, EPOCH, T0, bronze, build, paths, rows  # noqa: F401

CUTOFF = "2026-03-01"


def versioned(make_tasks, *tasks):
    """Tasks from (version, id, start, claim, end)."""
    frames = [make_tasks(tuple(t[1:])).withColumn("_mview_update_time", F.lit(t[0]).cast("timestamp_ntz")) for t in tasks]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


def same(spark, paths, tasks):
    assert rows(daily.read_summary(spark, paths[1])) == rows(daily.summary_of(tasks, CUTOFF, AS_OF))
    stored = daily.read_fact(spark, paths[0]).select("task_id", "task_start_date", "task_end_date")
    assert sorted(map(str, stored.collect())) == sorted(map(str, tasks.select(*stored.columns).collect()))


def test_an_older_change_after_a_newer_one_changes_nothing(spark, make_tasks, paths):  # noqa: F811
    newer = versioned(make_tasks, ("2026-01-06", "a", "2026-01-02", None, "2026-01-05"), ("2026-01-06", "b", "2026-01-02", None, None))
    build(spark, newer, paths, CUTOFF)
    daily.apply_changes(spark, versioned(make_tasks, ("2026-01-05", "a", "2026-01-02", None, None)), *paths, CUTOFF, AS_OF)
    same(spark, paths, newer)


@pytest.mark.parametrize("first_call", [True, False])
def test_two_versions_in_one_change_set_count_once(spark, make_tasks, paths, first_call):  # noqa: F811
    if not first_call:
        build(spark, versioned(make_tasks, ("2026-01-01", "z", "2026-01-01", None, None)), paths, CUTOFF)
    both = versioned(make_tasks, ("2026-01-05", "a", "2026-01-02", None, None), ("2026-01-06", "a", "2026-01-02", None, "2026-01-05"))
    daily.apply_changes(spark, both, *paths, CUTOFF, AS_OF)
    expected = versioned(make_tasks, ("2026-01-06", "a", "2026-01-02", None, "2026-01-05"),
                         *([] if first_call else [("2026-01-01", "z", "2026-01-01", None, None)]))
    same(spark, paths, expected)


def test_a_corrected_opening_date_leaves_the_old_month(spark, make_tasks, paths):  # noqa: F811
    build(spark, versioned(make_tasks, ("2026-01-05", "a", "2026-01-30", None, None)), paths, CUTOFF)
    moved = versioned(make_tasks, ("2026-01-06", "a", "2026-03-10", None, None))
    daily.apply_changes(spark, moved, *paths, CUTOFF, AS_OF)
    same(spark, paths, moved)


def test_a_failure_between_fact_and_summary_is_healed(spark, make_tasks, paths, monkeypatch):  # noqa: F811
    build(spark, versioned(make_tasks, ("2026-01-05", "a", "2026-01-30", None, "2026-02-20")), paths, CUTOFF)
    after = versioned(make_tasks, ("2026-01-06", "a", "2026-01-30", None, "2026-02-10"))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(daily, "refresh_summary", fails)
        with pytest.raises(RuntimeError):
            daily.apply_changes(spark, after, *paths, CUTOFF, AS_OF)
    daily.apply_changes(spark, after, *paths, CUTOFF, AS_OF)
    same(spark, paths, after)
    assert daily.open_partitions(spark, paths[1]).count() == 0


def test_the_newest_version_counts_though_an_older_one_touches_the_window(spark):
    at = lambda d, h=8: dt.datetime(2026, 1, d, h)
    tasks = [("t1", 1, "d1", "V3_a", "p1", "Weld", "E1", at(2), at(8), EPOCH, 1, at(8)),
             ("t1", 2, "d1", "V3_a", "p1", "Weld", "E1", at(2), at(12), at(13), 1, at(13))]
    window = daily.task_fact(bronze(spark, tasks), T0, "2026-01-08", "2026-01-09").collect()
    assert [(r.task_status, r.task_end_date) for r in window] == [("DONE", day("2026-01-13"))]


def test_old_variables_count_in_a_window(spark):
    old = bronze(spark, [("t1", 1, "d1", "V3_a", "p1", "Weld", "E1", dt.datetime(2027, 9, 2, 8), EPOCH, EPOCH, 1, T0)])
    assert daily.task_fact(old, T0, "2027-09-01", "2027-09-05").collect()[0].plant == "PA"


def test_late_files_reach_the_log(spark, tmp_path):
    landing, log, checkpoint = (str(tmp_path / x) for x in ("in", "log", "cp"))
    ddl = "id long, t timestamp_ntz, v long"
    for k, moment in enumerate(("2026-01-10 00:00:00", "2026-01-10 01:00:00", "2026-01-01 00:00:00")):
        spark.createDataFrame([(k, dt.datetime.fromisoformat(moment), 1)], ddl).coalesce(1).write.mode("append").parquet(landing)
        stream = changes.deduplicated(changes.change_stream(spark, landing, ddl), ["id", "v"])
        changes.run_available(stream, checkpoint, changes.append_with_batch(log, ["id"], ["v"]))
    assert sorted(r.id for r in spark.read.parquet(log).collect()) == [0, 1, 2]


def test_error_texts_are_whole_and_without_secrets(spark):
    text = "jdbc:sqlserver://h;user=u;password=p4ss;x " + "y" * 5000 + " https://u:hidden@host/ token: abc"
    kept = runs.checkpoint_row(spark, "facts", (T0, T0), runs.FAILED, T0, error=text).first()["error_msg"]
    assert "p4ss" not in kept and "hidden" not in kept and "abc" not in kept and "y" * 5000 in kept and "user=u" in kept


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return "spark://host:7077" if name == "spark.master" else default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_a_window_opens_only_the_months_of_its_tasks(spark, tmp_path):
    """Files of all other months are damaged: whoever opens one fails."""
    def task(key, month, *later):
        start = dt.datetime(2026, month, 5, 8)
        return (key, 1, "d1", "V3_a", "p1", "Weld", "E1", start, EPOCH, EPOCH, 1, start, *later)

    fact, summary = str(tmp_path / "f"), str(tmp_path / "s")
    tasks = [task("a", 1), task("b", 2), task("c", 3), task("z", 9)]
    daily.full_build(bronze(spark, tasks), fact, summary, CUTOFF, "2026-10-01", T0)
    for file in (tmp_path / "f" / "start_month=202609").glob("*.parquet"):
        file.write_bytes(b"PAR1 damaged PAR1")
    # Task b moves from February to March; it ended in January, so history is computed anew as well.
    moved = ("b", 2, "d1", "V3_a", "p1", "Weld", "E1", dt.datetime(2026, 3, 6, 8), EPOCH, dt.datetime(2026, 1, 20), 1, dt.datetime(2026, 3, 7))
    now = bronze(spark, [*tasks, moved])
    only = spark.createDataFrame([("p1", "b")], "PROC_INST_ID_ string, ID_ string")
    stored = spark.read.schema(daily.with_start_month(daily.task_fact(now, T0)).schema).parquet(fact)
    with pytest.raises(Exception, match="Parquet|parquet|PARQUET"):
        stored.where("start_month = '202609'").collect()
    assert daily.merge_tasks(now, only, fact, summary, CUTOFF, T0) == 1
    assert daily.refresh_open(spark, fact, summary, CUTOFF, "2026-10-01") == 1
    kept = daily.in_months(daily.read_fact(spark, fact), ["202601", "202602", "202603"])
    assert sorted((r.task_id, r.start_month) for r in kept.collect()) == [("a", "202601"), ("b", "202603"), ("c", "202603")]
    ended = daily.read_summary(spark, summary).where("period_type = 'Day' and snapshot_date = '2026-01-20'").collect()
    assert [r.done_qty for r in ended] == [1]


def test_the_index_of_event_months_names_all_of_them(spark, make_tasks, tmp_path):
    path = str(tmp_path / "f")
    tasks = make_tasks(("a", "2026-01-05", "2026-01-06", "2026-03-02"), ("b", "2026-02-05", None, "2026-03-09"), ("c", "2026-03-01", None, None))
    daily.write_fact(tasks, path)
    assert daily.opening_months_of(spark, path, ["202603"]) == ["202601", "202602"]
    assert daily.opening_months_of(spark, path, ["202601", "202609"]) == ["202601"]
    daily.merge_changes(spark, make_tasks(("c", "2026-03-01", None, "2026-09-02")), path, str(tmp_path / "s"), CUTOFF)
    assert daily.opening_months_of(spark, path, ["202609"]) == ["202603"]
    # A write of the whole fact that broke off: the index no longer says.
    open_row = spark.createDataFrame([("r", daily.OPENED, None)], daily.EVENT_MONTHS_DDL)
    open_row.coalesce(1).write.mode("append").parquet(daily.event_months_path(path))
    assert daily.opening_months_of(spark, path, ["202609"]) is None
    assert daily.opening_months_of(spark, str(tmp_path / "none"), ["202609"]) is None
