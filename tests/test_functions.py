import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.functions import dates, rates, values
from cohortmill.functions.status import cohort_status, live_status


def first(spark, column, ddl="x int", row=(1,)):
    return spark.createDataFrame([row], ddl).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, key, name", [
    ("2025-12-29", "2026-W01", "W1"), ("2023-01-01", "2022-W52", "W52"), ("2026-01-04", "2026-W01", "W1"),
    ("2020-12-31", "2020-W53", "W53"), ("2024-12-30", "2025-W01", "W1"),
])
def test_iso_week_labels_at_year_ends(spark, text, key, name):
    assert first(spark, dates.week_key(dates.as_date(text))) == key
    assert first(spark, dates.week_name(dates.as_date(text))) == name


def test_period_bounds(spark):
    d = dates.as_date("2026-02-11")
    assert first(spark, dates.period_start("Week", d)) == dt.date(2026, 2, 9)
    assert first(spark, dates.period_end("Week", d)) == dt.date(2026, 2, 15)
    assert first(spark, dates.period_end("Month", d)) == dt.date(2026, 2, 28)
    assert first(spark, dates.period_key("Month", d)) == "2026-02"
    assert first(spark, dates.period_name("Month", d)) == "Feb."
    with pytest.raises(ValueError):
        dates.period_end("Quarter", d)


def test_rates_with_zero_denominators_and_caps(spark):
    ddl, n, d = "n bigint, d bigint", F.col("n"), F.col("d")
    assert first(spark, rates.capped_floor_rate(n, d), ddl, (0, 0)) == 100
    assert first(spark, rates.floor_rate(n, d), ddl, (0, 0)) is None
    assert first(spark, rates.capped_floor_rate(n, d), ddl, (999, 1000)) == 99
    assert first(spark, rates.capped_floor_rate(n, d), ddl, (1000, 1000)) == 100
    assert first(spark, rates.rounded_rate(n, d), ddl, (1, 3)) == 33.33
    assert first(spark, rates.ratio_or_zero(n, d), ddl, (5, 0)) == 0.0
    assert first(spark, rates.percent_text(n, d), ddl, (49, 400)) == "12.2%"  # 12.25 rounds half to even
    assert first(spark, rates.percent_text(n, d), ddl, (1, 0)) == "-"


@pytest.mark.parametrize("part, whole, shown", [  # report percents read off a finished report
    (12, 2294, 0), (93, 2294, 4), (2189, 2294, 95), (2282, 2294, 99), (105, 2294, 4), (29, 583, 4), (537, 583, 92),
    (3, 3555, 0), (179, 3555, 5), (3373, 3555, 94), (3552, 3555, 99), (182, 3555, 5), (113, 198, 57),
])
def test_floor_percent_goldens(spark, part, whole, shown):
    assert first(spark, rates.capped_floor_rate(F.col("n"), F.col("d")), "n bigint, d bigint", (part, whole)) == shown


def test_sentinel_and_blanks(spark):
    ts = "t timestamp_ntz"
    assert first(spark, values.null_if_epoch(F.col("t")), ts, (dt.datetime(1970, 1, 1),)) is None
    assert first(spark, values.null_if_epoch(F.to_date("t")), ts, (dt.datetime(1970, 1, 1, 5),)) is None
    assert first(spark, values.null_if_epoch(F.col("t")), ts, (dt.datetime(2025, 1, 1),)) == dt.datetime(2025, 1, 1)
    assert first(spark, values.first_nonblank(F.col("a"), F.col("b")), "a string, b string", ("", "x")) == "x"
    assert first(spark, values.first_nonblank(F.col("a"), F.col("b")), "a string, b string", (None, "")) == ""


def test_cohort_statuses_of_one_task(spark, make_tasks):
    tasks = make_tasks(("t", "2025-12-01", "2025-12-04", "2025-12-05"))
    row = tasks.select(cohort_status("Day").alias("d"), cohort_status("Week").alias("w"), cohort_status("Month").alias("m")).first()
    assert (row.d, row.w, row.m) == ("TODO", "DONE", "DONE")


def test_open_tasks_are_never_done(spark, make_tasks):
    row = make_tasks(("t", "2025-12-01", None, None)).select(cohort_status("Week").alias("w"), cohort_status("Day").alias("d")).first()
    assert (row.w, row.d) == ("TODO", "TODO")


def test_live_status_is_by_assignee(spark):
    ddl = "e date, a string"
    status = live_status(F.col("e"), F.col("a"))
    assert first(spark, status, ddl, (None, "E1")) == "DOING"
    assert first(spark, status, ddl, (None, "")) == "TODO"
    assert first(spark, status, ddl, (dt.date(2025, 1, 1), None)) == "DONE"


def test_calendar_agrees_with_python_on_every_day_of_forty_years(spark):
    days = spark.sql("SELECT explode(sequence(date'1995-01-01', date'2035-12-31')) AS d")
    rows = days.select(
        "d", dates.week_key("d").alias("week"), dates.month_key("d").alias("month"), dates.month_name("d").alias("name"),
        dates.period_start("Week", "d").alias("monday"), dates.period_end("Month", "d").alias("last"),
    ).collect()
    for r in rows:
        iso = r.d.isocalendar()
        assert r.week == f"{iso.year}-W{iso.week:02d}"
        assert (r.month, r.name) == (f"{r.d:%Y-%m}", f"{r.d:%b}.")
        assert r.monday == r.d - dt.timedelta(days=r.d.weekday())
        assert (r.last + dt.timedelta(days=1)).day == 1 and r.last.month == r.d.month
