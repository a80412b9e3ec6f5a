"""Stored rollups: one pass, renewed by period, and reports from them equal those of the summary."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.operators import cohort
from cohortmill.operators.summary import SUMMARY_COLUMNS
from cohortmill.plans import daily, reports, rollup_store
from tests.test_summary import frame, random_tasks

AS_OF, CUTOFF = "2026-04-01", "2025-12-01"


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select("rollup", *SUMMARY_COLUMNS).collect())


@pytest.fixture
def stored(spark, make_tasks, tmp_path):
    tasks = random_tasks(21, n=90)
    paths = str(tmp_path / "fact"), str(tmp_path / "summary")
    daily.write_fact(frame(make_tasks, tasks), paths[0])
    daily.write_summary(daily.summary_of(daily.read_fact(spark, paths[0]), CUTOFF, AS_OF), paths[1])
    root = rollup_store.rollup_path(paths[1])
    rollup_store.store_rollups(daily.read_summary(spark, paths[1]), root)
    return tasks, paths, root


def test_changes_renew_the_rollups_of_their_periods(spark, make_tasks, stored):
    tasks, paths, root = stored
    changed = [(t[0], t[1], t[2], t[1] + dt.timedelta(days=2), "P9", t[5]) for t in tasks[:8]]
    daily.apply_changes(spark, frame(make_tasks, changed), *paths, CUTOFF, AS_OF)
    expected = rows(rollup_store.rollup_rows(daily.read_summary(spark, paths[1])))
    assert rows(rollup_store.read_rollups(spark, root)) == expected
    sizes = rollup_store.rollup_sizes(spark, root)
    counted = {r["rollup"]: r["count"] for r in rollup_store.read_rollups(spark, root).groupBy("rollup").count().collect()}
    assert sizes == counted


def test_periods_without_rows_leave_no_old_numbers(spark, make_tasks, stored):
    tasks, paths, root = stored
    gone = [(*t[:5], 1) for t in tasks]
    daily.apply_changes(spark, frame(make_tasks, gone), *paths, CUTOFF, AS_OF)
    assert rollup_store.read_rollups(spark, root).isEmpty()
    assert set(rollup_store.rollup_sizes(spark, root).values()) == {0}


@pytest.mark.parametrize("by, dims", [
    ((), {}), (("plant",), {}), (("vx_type",), {"plant": "P1"}), ((), {"line": "L1"}), (("plant",), {"vx_type": ["V3"], "region": "ALL"}),
])
def test_reports_equal_those_of_the_summary(spark, stored, by, dims):
    _, paths, root = stored
    whole = daily.read_summary(spark, paths[1])
    served = rollup_store.serve(whole, root, by, **dims)
    anchor = reports.anchor_date(whole, "2026-01-10", **dims).first()["anchor"]
    assert reports.anchor_date(served, "2026-01-10", **dims).first()["anchor"] == anchor
    group = ["granularity", "period_name", *by]

    def measures(summary):
        found = reports.periodic_measures(reports.periodic_report(summary, anchor, **dims), group)
        return sorted(tuple(str(v) for v in r) for r in found.select(sorted(found.columns)).collect())

    assert measures(served) == measures(whole) != []


def test_the_smallest_rollup_that_covers_a_request():
    lattice, sizes = {"a": (), "b": ("plant",), "c": ("plant", "line")}, {"a": 3, "b": 10, "c": 40}
    pick = lambda *needed: rollup_store.smallest_covering(sizes, needed, lattice)
    assert (pick(), pick("plant"), pick("line"), pick("vx_type")) == ("a", "b", "c", None)


def test_wrong_lattices_and_missing_ones(spark, stored, tmp_path):
    _, paths, _ = stored
    whole = daily.read_summary(spark, paths[1])
    with pytest.raises(ValueError, match="not a dimension"):
        rollup_store.rollup_rows(whole, {"x": ("nowhere",)})
    with pytest.raises(ValueError, match="same levels"):
        rollup_store.rollup_rows(whole, {"x": ("plant", "line"), "y": ("line", "plant")})
    nowhere = str(tmp_path / "none")
    rollup_store.refresh_rollups(whole, nowhere, ["202601"])
    assert rollup_store.serve(whole, nowhere) is whole
    rollup_store.store_rollups(whole.limit(0), nowhere)
    assert rollup_store.serve(whole.limit(0), nowhere).isEmpty()


def test_a_lattice_is_replaced_as_a_whole(spark, stored):
    _, paths, root = stored
    whole = daily.read_summary(spark, paths[1])
    rollup_store.store_rollups(whole, root, {"lines": ("line",)})
    assert [r[0] for r in rollup_store.read_rollups(spark, root).select("rollup").distinct().collect()] == ["lines"]
    rollup_store.refresh_rollups(whole, root, ["202601"])
    assert set(rollup_store.stored_lattice(spark, root)) == {"lines"} == set(rollup_store.rollup_sizes(spark, root))


def test_null_levels_are_not_taken_for_rolled_away_ones(spark, stored):
    _, paths, _ = stored
    whole = daily.read_summary(spark, paths[1]).withColumn("plant", F.lit(None).cast("string"))
    lattice = {"none": (), "plants": ("region", "plant")}
    names = rollup_store.rollup_rows(whole, lattice).groupBy("rollup").agg(F.sum("total_qty").alias("n")).collect()
    assert {r["rollup"] for r in names} == set(lattice) and len({r["n"] for r in names}) == 1


def test_rolling_total_against_the_explode_by_seven(spark, make_tasks):
    cells = cohort.cohort_cells(frame(make_tasks, random_tasks(5, n=70)))
    got = cohort.rolling_total(cells, ["plant"], "snapshot_date", "total_task", "n")
    expected = cohort.acc_rolling(cells).groupBy("plant", "snapshot_date").agg(F.sum("acc_total_task").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.select("plant", "snapshot_date", "n").collect()))
    assert cohort.rolling_total(cells.limit(0), ["plant"], "snapshot_date", "total_task", "n").isEmpty()


def test_rolling_total_of_missing_days_and_counts(spark):
    made = spark.createDataFrame(
        [("a", dt.date(2026, 1, 1), 2), ("a", dt.date(2026, 1, 1), None), ("a", dt.date(2026, 1, 4), 1), ("a", None, 9),
         (None, dt.date(2026, 1, 1), None)], "g string, d date, n bigint")
    got = {(r["g"], r["d"].day): r["s"] for r in cohort.rolling_total(made, ["g"], "d", "n", "s", days=2).collect()}
    assert got == {("a", 1): 2, ("a", 2): 2, ("a", 4): 1, ("a", 5): 1, (None, 1): 0, (None, 2): 0}
