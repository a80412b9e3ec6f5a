"""Dense numbers for string ids, and period totals from merged daily bitmaps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import cohort, summary
from cohortmill.operators import task_sets as operators
from cohortmill.plans import task_sets
from cohortmill.sources.tables import stages
from tests.test_summary import frame, random_tasks


def ids_of(dictionary):
    return {r["task_id"]: r["id"] for r in dictionary.collect()}


@pytest.mark.parametrize("per_part", [1, 7, 1_000_000])
def test_numbers_are_dense_and_follow_the_day(spark, per_part):
    days = [dt.date(2026, 1, 1 + k % 3) if k % 11 else None for k in range(60)]
    rows = spark.createDataFrame([(f"t{k}", day) for k, day in enumerate(days)], "task_id string, day date")
    with stages(spark) as stage:
        got = ids_of(operators.number_ids(rows, 100, stage, per_part))
        again = ids_of(operators.number_ids(rows.repartition(5), 100, stage, per_part))
    assert sorted(got.values()) == list(range(100, 160)) and got == again
    ordered = [days[int(task[1:])] or dt.date.min for task in sorted(got, key=got.get)]
    assert ordered == sorted(ordered)


def test_a_dictionary_grows_by_new_ids_only(spark, make_tasks, tmp_path):
    path = str(tmp_path / "ids")
    tasks = frame(make_tasks, random_tasks(3, n=40))
    assert task_sets.extend_dictionary(tasks.limit(0), path) == 0 and task_sets.read_dictionary(spark, path) is None
    early = tasks.where("task_start_date < '2026-01-05'")
    first = task_sets.extend_dictionary(early, path)
    before = ids_of(task_sets.read_dictionary(spark, path))
    repeats = tasks.union(tasks).union(tasks.limit(1).withColumn("task_id", F.lit(None).cast("string")))
    assert first == len(before) and task_sets.extend_dictionary(repeats, path) == 40 - first
    after = ids_of(task_sets.read_dictionary(spark, path))
    assert {t: after[t] for t in before} == before and sorted(after.values()) == list(range(40))
    assert task_sets.extend_dictionary(repeats, path) == 0


@pytest.mark.parametrize("grain", ["Week", "Month"])
def test_merged_sets_give_the_backlog_of_the_summary(spark, make_tasks, tmp_path, grain):
    tasks = frame(make_tasks, random_tasks(8, n=120))
    ids, sets = str(tmp_path / "ids"), str(tmp_path / "sets")
    task_sets.extend_dictionary(tasks, ids)
    task_sets.write_sets(tasks, task_sets.read_dictionary(spark, ids), sets)
    totals = operators.backlog_totals(task_sets.read_sets(spark, sets), grain)
    got = sorted((r["plant"], r["line"], r["acc_total_qty"]) for r in totals.collect())
    whole = summary.current_summary(cohort.cohort_cells(tasks), [grain])
    assert got == sorted((r["plant"], r["line"], r["acc_total_qty"]) for r in whole.collect()) != []


def test_months_are_renewed_and_emptied(spark, make_tasks, tmp_path):
    ids, sets = str(tmp_path / "ids"), str(tmp_path / "sets")
    tasks = frame(make_tasks, random_tasks(8, n=60)).withColumn("start_month", F.date_format("task_start_date", "yyyyMM"))
    task_sets.extend_dictionary(tasks, ids)
    dictionary = task_sets.read_dictionary(spark, ids)
    task_sets.write_sets(tasks.drop("start_month"), dictionary, sets)
    months = sorted(r[0] for r in tasks.select("start_month").distinct().collect())
    kept = tasks.withColumn("is_excluded", F.when(F.col("start_month") == months[0], 1).otherwise(F.col("is_excluded")))
    task_sets.refresh_sets(kept, dictionary, sets, months)
    held = task_sets.read_sets(spark, sets)
    expected = operators.opened_sets(kept, dictionary)
    count = lambda df: sorted((str(r[0]), r[1]) for r in df.groupBy("snapshot_date").agg(
        F.sum(F.bitmap_count("opened"))).collect())
    assert count(held) == count(expected) and held.where(F.date_format("snapshot_date", "yyyyMM") == months[0]).isEmpty()
