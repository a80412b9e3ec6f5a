import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import cohort, summary
from cohortmill.plans import daily, recon, reports
from cohortmill.sources import export

SUMMARY_DDL = (
    "period_type string, period_key string, snapshot_date date, sort_order int, period_name string, vx_type string, "
    "region string, plant string, factory string, line string, total_qty bigint, todo_qty bigint, doing_qty bigint, "
    "done_qty bigint, doing_done_qty bigint, acc_qty bigint, acc_total_qty bigint"
)


def summary_row(grain, key, snapshot, name, total, todo, doing, done, acc, acc_total, plant="WEST"):
    return (grain, key, dt.date.fromisoformat(snapshot), 0, name, "V3", "R", plant, "F", "L",
            total, todo, doing, done, doing + done, acc, acc_total)


@pytest.fixture
def december(spark):
    """A finished December page: known counts per month, week and day."""
    return spark.createDataFrame([
        summary_row("Month", "2025-12", "2025-12-31", "Dec.", 2294, 12, 93, 2189, 105, 2294),
        summary_row("Week", "2026-W01", "2025-12-31", "W1", 12, 5, 0, 7, 5, 12),
        summary_row("Week", "2025-W52", "2025-12-28", "W52", 583, 29, 17, 537, 46, 583),
        summary_row("Week", "2025-W51", "2025-12-21", "W51", 502, 19, 12, 471, 31, 502),
        summary_row("Week", "2025-W50", "2025-12-14", "W50", 1, 1, 0, 0, 1, 1),
        summary_row("Day", "2025-12-31", "2025-12-31", "2025-12-31", 210, 9, 5, 196, 97, 812),
        summary_row("Day", "2025-12-30", "2025-12-30", "2025-12-30", 262, 8, 60, 194, 95, 800),
        summary_row("Day", "2025-12-24", "2025-12-24", "2025-12-24", 1, 1, 0, 0, 1, 1),
    ], SUMMARY_DDL)


def test_report_of_a_known_page(december):
    report = reports.periodic_report(december, "2025-12-31")
    shown = {r.period_name: r for r in reports.periodic_measures(report, ["granularity", "period_name"]).collect()}
    assert sorted(shown) == ["2025-12-30", "2025-12-31", "Dec.", "W1", "W51", "W52"]
    assert [shown[n].period_sort_order for n in ("Dec.", "W1", "W52", "W51", "2025-12-31", "2025-12-30")] == [1, 2, 3, 4, 5, 6]
    assert (shown["Dec."].todo_rate, shown["Dec."].doing_rate, shown["Dec."].done_rate, shown["Dec."].acc_rate) == (0, 4, 95, 4)
    assert (shown["W52"].done_rate, shown["W52"].doing_done_rate, shown["W52"].acc_rate) == (92, 95, 7)
    assert (shown["W1"].todo_rate, shown["W1"].done_rate, shown["W1"].acc_rate) == (41, 58, 41)
    assert (shown["2025-12-31"].done_rate, shown["2025-12-31"].acc_rate) == (93, 11)


def test_pivot_has_six_lines_per_row(december):
    report = reports.periodic_report(december, "2025-12-31")
    pivot = reports.periodic_pivot(report)
    assert pivot.count() == 6 * report.count()
    week = {r.status_name: (r.task_qty, r.task_pct) for r in pivot.where("period_name = 'W52'").collect()}
    assert week["1. Total Task"] == (583, 100.0) and week["6. Todo+Doing(Acc)"] == (46, 7.0)


def test_anchor_is_capped_and_null_for_nothing(december):
    def anchor(**kw):
        return reports.anchor_date(december, **kw).first()["anchor"]

    assert anchor(as_of="2026-06-01") == dt.date(2025, 12, 31)
    assert anchor(as_of="2025-12-30") == dt.date(2025, 12, 30)
    assert anchor(as_of="2026-06-01", date_to="2025-12-29") == dt.date(2025, 12, 24)
    assert anchor(as_of="2026-06-01", plant="nowhere") is None
    empty = reports.anchor_date(december, "2026-06-01", plant="nowhere")
    assert reports.periodic_report(december, empty, plant="nowhere").count() == 0


def test_report_scans_the_summary_once_and_pushes_a_literal_anchor(spark, december, tmp_path):
    december.write.parquet(str(tmp_path / "s"))
    report = reports.periodic_report(spark.read.parquet(str(tmp_path / "s")), dt.date(2025, 12, 31), plant="WEST")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(plant,WEST)" in pushed and "period_type" in pushed.split("ReadSchema")[0]


def test_report_calendar():
    calendar = reports.report_calendar("2026-01")
    assert calendar["days"] == [f"2026-01-{d}" for d in range(31, 24, -1)]
    assert calendar["weeks"] == ["W5", "W4", "W3"] and calendar["month_label"] == "Jan."
    assert reports.report_calendar("2025-12")["weeks"] == ["W1", "W52", "W51"]
    with pytest.raises(ValueError):
        reports.report_calendar("202512")


def test_monthly_report_uses_the_newest_backlog_of_each_group(december):
    lines = {(r.period_type, r.label, r.status): (r.qty, r.percentage) for r in reports.monthly_report(december, "2025-12").collect()}
    assert lines[("Monthly", "Total", "Total Task")] == (473, "-")
    assert lines[("Monthly", "Total", "Todo+Doing(Acc)")] == (97, "20.5%")
    assert lines[("Daily", "2025-12-31", "Done")] == (196, "93.3%")
    assert ("Daily", "2025-12-24", "Done") not in lines


def test_file_months_and_detail_proofs(spark, make_tasks):
    tasks = make_tasks(("a", "2026-02-20", "2026-03-01", "2026-03-31"), ("b", "2026-03-31", "2026-04-02", None),
                       ("c", "2026-04-01", None, "2026-05-01"))
    files = reports.file_months(tasks, "2026-04-01")
    got = sorted((r.task_id, r.file_month, r.in_month_cohort) for r in files.collect())
    assert got == [("a", "2026-02", 1), ("a", "2026-03", 0), ("b", "2026-03", 1), ("c", "2026-04", 1)]
    old = recon.detail_day_counts(files, cohort=False, day="2026-03-31").first()
    assert (old.total, old.todo, old.doing, old.done) == (2, 1, 0, 1)
    months = {r.file_month: r.total for r in recon.detail_month_counts(files).collect()}
    assert months == {"2026-02": 1, "2026-03": 1, "2026-04": 1}
    cells = cohort.cohort_cells(tasks)
    monthly = recon.summary_counts(summary.month_summary(cells), "Month").withColumnRenamed("period_key", "file_month")
    assert recon.proof_differences(recon.detail_month_counts(files), monthly, ["file_month", "vx_type"]).count() == 0


def test_export_preview_and_dry_run(spark, make_tasks, tmp_path):
    tasks = make_tasks(("a", "2026-02-20", "2026-03-01", "2026-03-31"), ("b", "2026-03-31", "2026-03-31", None))
    preview = export.export_month(tasks, str(tmp_path / "out"), "2026-03", "2026-04-01", dry_run=True)
    assert [tuple(r) for r in preview.collect()] == [("V3", 1, 0, 1, 0)]
    assert not (tmp_path / "out").exists()
    export.export_month(tasks, str(tmp_path / "out"), "2026-03", "2026-04-01")
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(r.task_id for r in back.collect()) == ["a", "b"]
    assert any(p.name.endswith(".csv.gz") for p in (tmp_path / "out").rglob("*"))


def test_serving_view_columns(spark, make_tasks):
    cells = cohort.cohort_cells(make_tasks(("a", "2026-02-20", None, None)))
    reports.serving_view(cohort.completion_from_cells(cells), "served")
    assert spark.table("served").where(F.col("total_task") == 1).count() == 1


def test_drill_and_month_files_on_disk(spark, make_tasks, tmp_path):
    tasks = make_tasks(("a", "2026-02-20", "2026-03-01", "2026-03-31"), ("b", "2026-02-20", "2026-02-20", None),
                       ("x", "2026-02-20", None, None, "P1", 1)).withColumns({
        "task_start_time": F.col("task_start_date").cast("timestamp_ntz"),
        "task_end_time": F.col("task_end_date").cast("timestamp_ntz")})
    drill = reports.audit_drill(tasks, "2026-02-20", "all", plant="P1")
    assert [r.task_id for r in drill.collect()] == ["a", "b"]  # ended first, then open ones
    export.write_csv(drill, str(tmp_path / "drill"))
    assert spark.read.option("header", True).csv(str(tmp_path / "drill")).count() == 2
    export.export_monthly_detail(tasks, str(tmp_path / "files"), "2026-04-01")
    folders = sorted(p.name for p in (tmp_path / "files").iterdir() if p.is_dir())
    assert folders == ["_by_file_month=2026-02", "_by_file_month=2026-03"]
    back = spark.read.option("header", True).csv(str(tmp_path / "files" / "_by_file_month=2026-03"))
    assert [(r.task_id, r.file_month, r.in_month_cohort) for r in back.collect()] == [("a", "2026-03", "0")]


@pytest.mark.parametrize("anchor, month", [("2026-01-05", "2026-01"), (dt.date(2025, 12, 31), "2025-12")])
def test_reports_open_only_their_months(spark, make_tasks, tmp_path, anchor, month):
    tasks = make_tasks(*[(f"t{y}{m}{d}", f"{y}-{m:02d}-{d:02d}", None, f"{y}-{m:02d}-{d + 1:02d}")
                         for y, m in ((2025, 10), (2025, 11), (2025, 12), (2026, 1), (2026, 2)) for d in (1, 5, 15, 27)])
    whole = daily.summary_of(tasks, "2020-01-01", "2026-04-01")
    daily.write_summary(whole, str(tmp_path / "s"))
    stored = daily.read_summary(spark, str(tmp_path / "s"))
    for report in (lambda s: reports.periodic_report(s, anchor), lambda s: reports.monthly_report(s, month)):
        pruned = report(stored)
        assert sorted(map(str, pruned.collect())) == sorted(map(str, report(whole).collect()))
        assert "period_month" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
