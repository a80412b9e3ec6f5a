import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.plans import runs
from cohortmill.sources import ingest, readers
from cohortmill.sources.catalog import BATCH, SOURCE_TABLES, TableSpec

T = dt.datetime


def windows(spark, start, end, step):
    bounds = spark.createDataFrame([(start, end)], "s string, e string").select(
        F.col("s").cast("date").alias("start_date"), F.col("e").cast("date").alias("end_date"))
    return [tuple(r) for r in runs.etl_windows(bounds, step_days=step).orderBy("window_start").collect()]


def check_cover(got, first, stop, length):
    """Windows follow each other without gap or overlap from first to stop; only the last may be short."""
    assert got[0][0] == first and got[-1][1] == stop
    assert all(left[1] == right[0] for left, right in zip(got, got[1:]))
    assert all(hi - lo == length for lo, hi in got[:-1]) and T.min < got[-1][0] < stop and stop - got[-1][0] <= length


@pytest.mark.parametrize("days, step", [(1, 3), (6, 3), (8, 3), (45, 7)])
def test_windows_and_batches_cover_their_range(spark, days, step):
    first = T(2026, 2, 20)
    last = first + dt.timedelta(days=days - 1)
    stop, length = last + dt.timedelta(days=1), dt.timedelta(days=step)
    check_cover(windows(spark, str(first.date()), str(last.date()), step), first, stop, length)
    batches = runs.ingest_batches(spark, str(first.date()), str(last.date()), step_days=step)
    check_cover([tuple(r) for r in batches.orderBy("window_start").collect()], first, stop, length)
    hourly = runs.ingest_batches(spark, str(first), str(first + dt.timedelta(hours=days)), step_hours=step)
    check_cover([tuple(r) for r in hourly.orderBy("window_start").collect()], first,
                first + dt.timedelta(hours=days), dt.timedelta(hours=step))


MARKS = ingest.WATERMARK_DDL


def mark(table, synced, reached):
    return (table, synced, T(2026, 1, 1), 1, 0.0, None, reached)


def test_catchup_bounds(spark):
    marks = spark.createDataFrame([
        mark("bpm_act_hi_taskinst", T(2026, 1, 20), T(2026, 1, 19)), mark("bpm_act_hi_varinst", T(2026, 1, 20), T(2026, 1, 12))], MARKS)
    done = spark.createDataFrame([("summary", T(2026, 1, 1), T(2026, 1, 15), "SUCCESS", "", 0.0, 0, 0, T(2026, 1, 16))], runs.CHECKPOINT_DDL)
    none = done.where("false")
    got = tuple(runs.catchup_range(marks, done, as_of="2026-02-01").first())
    assert got == (dt.date(2026, 1, 11), dt.date(2026, 1, 20))
    assert tuple(runs.catchup_range(marks, none, as_of="2026-02-01").first()) == (dt.date(2026, 1, 6), dt.date(2026, 1, 20))
    assert tuple(runs.catchup_range(marks.where("false"), none, as_of="2026-02-01").first()) == (dt.date(2026, 1, 18), dt.date(2026, 2, 1))


def test_pending_windows_need_input_and_no_success(spark):
    bounds = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 1, 5))], "start_date date, end_date date")
    grid = runs.etl_windows(bounds, step_days=1)
    log = None
    for window_day, status, at in ((1, "SUCCESS", 1), (2, "FAILED", 1), (3, "SUCCESS", 1), (3, "FAILED", 2)):
        row = runs.checkpoint_row(spark, "facts", (T(2026, 1, window_day), T(2026, 1, window_day + 1)), status, T(2026, 2, at))
        log = row if log is None else log.unionByName(row)
    active = spark.createDataFrame([(dt.date(2026, 1, d),) for d in (1, 2, 3, 5)], "day date")
    got = sorted(r.window_start.day for r in runs.pending_windows(grid, log, "facts", active).collect())
    assert got == [2, 3, 5]


def test_a_run_leaves_a_checkpoint_whatever_happens(spark, tmp_path):
    path, window = str(tmp_path / "log"), (T(2026, 1, 1), T(2026, 1, 2))
    ticks = iter(T(2026, 2, 1, 0, 0, s) for s in range(0, 60, 2))
    with pytest.raises(RuntimeError):
        runs.run_phase(spark, path, "facts", window, lambda: (_ for _ in ()).throw(RuntimeError("lost")), lambda: next(ticks))
    assert runs.latest_checkpoints(spark.read.parquet(path)).first()["error_msg"] == "lost"
    assert runs.run_phase(spark, path, "facts", window, lambda: 7, lambda: next(ticks)) == 7
    row = runs.latest_checkpoints(spark.read.parquet(path)).first()
    assert (row.status, row.result_rows, row.duration_ms) == ("SUCCESS", 7, 2000.0)


def test_affected_periods_reach_backlog_days_and_next_periods(spark, make_tasks):
    changed = make_tasks(("a", "2025-12-30", "2026-01-20", None))
    got = {(r.period_type, r.period_key) for r in runs.affected_periods(changed, "2026-01-01").collect()}
    days = {("Day", f"2025-12-{d}") for d in (30, 31)} | {("Day", f"2026-01-0{d}") for d in range(1, 6)}
    assert got == days | {("Week", "2026-W01"), ("Week", "2026-W02"), ("Month", "2025-12"), ("Month", "2026-01")}
    early = {r.period_key for r in runs.affected_periods(changed, "2026-02-01").where("period_type = 'Day'").collect()}
    assert "2026-01-20" in early


def test_readable_size(spark):
    df = spark.createDataFrame([(0,), (1536,), (3 * 1024 ** 3,)], "b bigint")
    assert [r.s for r in df.select(runs.readable_size(F.col("b")).alias("s")).collect()] == ["0.00 B", "1.50 KiB", "3.00 GiB"]


def test_freshness_states(spark):
    ddl = "table_name string, strategy string, current_rows bigint, last_success timestamp_ntz"
    now = T(2026, 1, 2, 12)
    df = spark.createDataFrame([("a", "full", 0, now), ("b", "batch", 0, now), ("c", "batch", 5, T(2026, 1, 1, 12)), ("d", "full", 1, None)], ddl)
    assert {r.table_name: r.status for r in runs.table_freshness(df, now).collect()} == {"a": "empty", "b": "ok", "c": "stale", "d": "stale"}


def test_catalog_is_complete(spark):
    assert len(SOURCE_TABLES) == 19
    assert sum(s.strategy == BATCH for s in SOURCE_TABLES.values()) == 4
    for spec in SOURCE_TABLES.values():
        names = set(spec.schema.fieldNames()) | set(spec.derived)
        assert set(spec.keys) <= names and (spec.time_col is None or spec.time_col in names)
    with pytest.raises(ValueError):
        TableSpec("x", "x", "full", " ", ("a",))
    with pytest.raises(ValueError):
        TableSpec("x", "x", "batch", "a int", ("a",))
    with pytest.raises(KeyError):
        readers.table_spec("nowhere")


def test_declared_read_from_csv(spark, tmp_path):
    (tmp_path / "e.csv").write_text("EmpCode,EmpName,DeptCode,TerminateDate,ModifyDate\n"
                                    "1,Ann,D,,2025-01-01 00:00:00\n2,Bo,D,1970-01-01 00:00:00,\n3,Cy,D,2025-05-05 00:00:00,\n")
    people = readers.read_source(spark, "hr_employee", str(tmp_path / "e.csv"), "csv")
    assert {r.EmpCode: r.IsActive for r in people.collect()} == {"1": 1, "2": 1, "3": 0}
    assert "TerminateDate" not in people.columns


def test_range_predicates_quote_values():
    assert readers.range_predicates("c", [("a", "b'c")]) == ["c >= 'a' AND c < 'b''c'"]
