import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cohortmill.operators.filters import apply_retention
from cohortmill.operators.versions import latest_by_key
from cohortmill.plans import daily
from cohortmill.sources import ingest, readers, tables
from cohortmill.streaming import changes

NOW = dt.datetime(2026, 1, 1)


def test_empty_full_load_keeps_the_previous_snapshot(spark, tmp_path):
    root = str(tmp_path / "t")
    assert ingest.ingest_full(spark.range(3), root, "b1", NOW) == 3
    with pytest.raises(tables.EmptySnapshotError):
        ingest.ingest_full(spark.range(0), root, "b2", NOW)
    assert tables.read_snapshot(spark, root).count() == 3
    ingest.ingest_full(spark.range(5), root, "b3", NOW)
    current = tables.read_snapshot(spark, root)
    assert current.count() == 5 and current.select("_batch_id").distinct().first()[0] == "b3"
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, str(tmp_path / "none"))


def test_old_versions_are_emptied_but_for_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (3, 5, 7, 9):
        tables.replace_snapshot(spark.range(n), root, keep=2)
    held = sorted(spark.read.parquet(str(f)).count() for f in (tmp_path / "t").glob("version=*"))
    assert held == [0, 0, 7, 9] and tables.read_snapshot(spark, root).count() == 9
    assert tables.expire_versions(spark, root, 2) == 0 and tables.expire_versions(spark, root, 1) == 1
    assert tables.read_snapshot(spark, root).count() == 9
    with pytest.raises(ValueError, match="at least 1"):
        tables.expire_versions(spark, root, 0)


def test_stages_give_their_space_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "scratch_path", lambda spark, name: str(tmp_path / name))
    with tables.stages(spark) as stage:
        first = stage(spark.range(4))
        assert first.count() == 4 and stage(first.where("id > 1")).count() == 2
    assert not [f for f in (tmp_path / "stages").iterdir() if f.is_dir()]
    with pytest.raises(RuntimeError), tables.stages(spark) as stage:
        stage(spark.range(4))
        raise RuntimeError
    assert not [f for f in (tmp_path / "stages").iterdir() if f.is_dir()]


def test_updates_leave_no_staged_rows(spark, make_tasks, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "scratch_path", lambda spark, name: str(tmp_path / "scratch" / f"{name}-{uuid.uuid4().hex}"))
    fact, summary = str(tmp_path / "fact"), str(tmp_path / "summary")
    for end in (None, "2025-06-03"):
        daily.apply_changes(spark, make_tasks(("a", "2025-06-01", None, end)), fact, summary, "2025-01-01", "2025-07-01")
    folders = list((tmp_path / "scratch").iterdir())
    assert folders and not [f for folder in folders for f in folder.iterdir() if f.is_dir()]


def test_batch_tables_are_read_in_ranges_over_jdbc(spark):
    with pytest.raises(ValueError, match="in ranges"):
        readers.read_jdbc(spark, "taskinst", {"url": "jdbc:none"}, "t")


def test_failed_load_keeps_the_previous_snapshot(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.replace_snapshot(spark.range(3), root)
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        tables.replace_snapshot(broken, root)
    assert tables.read_snapshot(spark, root).count() == 3


def test_period_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "p string, x int")
    tables.overwrite_periods(first, path, ["p"])
    for _ in range(2):
        tables.overwrite_periods(spark.createDataFrame([("a", 9)], "p string, x int"), path, ["p"])
    assert sorted((r.p, r.x) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3)]
    assert tables.remove_partitions(spark.createDataFrame([("b",), ("zzz",)], "p string"), path, ["p"]) == 1
    assert [r.p for r in spark.read.parquet(path).collect()] == ["a"]


def test_retention_empties_whole_months(spark, make_tasks, tmp_path):
    path = str(tmp_path / "r")
    tasks = make_tasks(("a", "2024-11-30", None, None), ("b", "2024-12-05", None, None), ("c", "2025-06-01", None, None), ("d", None, None, None))
    daily.write_fact(tasks, path)
    assert daily.retire_months(spark, path, dt.date(2025, 12, 31), 1) == ["202411"]
    assert sorted(r.task_id for r in daily.read_fact(spark, path).collect()) == ["b", "c", "d"]
    kept = apply_retention(daily.read_fact(spark, path), "task_start_date", "2025-12-31", 1)
    assert [r.task_id for r in kept.collect()] == ["c"]


def test_watermark_and_resume(spark, tmp_path):
    path = str(tmp_path / "w")
    data = spark.createDataFrame([(dt.datetime(2025, 11, 3),), (dt.datetime(2025, 11, 9),)], "t timestamp_ntz")
    ingest.update_watermark(data, path, "a", "t", "2025-11-10 00:00:00", dt.datetime(2025, 11, 10))
    ingest.update_watermark(data.where("false"), path, "b", "t", "2025-11-10 00:00:00", dt.datetime(2025, 11, 10))
    marks = spark.read.parquet(path)

    def resume(table, floor=None):
        return ingest.resume_point(marks, table, floor).first()["resume_at"]

    assert resume("a") == dt.datetime(2025, 11, 9)
    assert resume("b") == dt.datetime(2025, 11, 10)
    assert resume("c", "2025-10-01") == dt.datetime(2025, 10, 1)
    assert resume("c") == dt.datetime(2025, 1, 1)


def test_window_bounds_are_pushed_to_the_files(spark, tmp_path):
    spark.createDataFrame([(dt.datetime(2025, 11, 3), 1)], "t timestamp_ntz, x int").write.parquet(str(tmp_path / "t"))
    window = ingest.in_window(spark.read.parquet(str(tmp_path / "t")), "t", "2025-11-01", "2025-12-01")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan


def test_stream_continues_and_drops_repeats(spark, tmp_path):
    landing, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    ddl = "id string, v int, t timestamp"
    base = dt.datetime(2026, 1, 1)

    def land(*rows):
        spark.createDataFrame([(i, v, base + dt.timedelta(minutes=m)) for i, v, m in rows], ddl).coalesce(1).write.mode("append").parquet(landing)

    def step():
        stream = changes.deduplicated(changes.change_stream(spark, landing, ddl), ["id", "v"])
        changes.run_available(stream, checkpoint, changes.append_with_batch(log, ["id"], ["v"]))
        return sorted((r.id, r.v) for r in spark.read.parquet(log).collect())

    land(("a", 1, 0), ("a", 1, 1), ("b", 1, 2))
    assert step() == [("a", 1), ("b", 1)]
    land(("a", 1, 3), ("a", 2, 4))
    assert step() == [("a", 1), ("a", 2), ("b", 1)]
    newest = latest_by_key(spark.read.parquet(log), ["id"], ["v"])
    assert sorted((r.id, r.v) for r in newest.collect()) == [("a", 2), ("b", 1)]
