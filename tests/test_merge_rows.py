"""A merge decides on keys, versions and dates: whole rows are staged once."""

import datetime as dt

import pytest

from cohortmill.plans import daily

DDL = ("task_id string, task_start_date date, task_claim_date date, task_end_date date, line string, "
       "_mview_update_time timestamp_ntz")


def rows(spark, *tasks):
    full = [(task, dt.date(2025, month, 1), None, None, line, None if hour is None else dt.datetime(2025, 6, 1, hour))
            for task, month, line, hour in tasks]
    return daily.with_start_month(spark.createDataFrame(full, DDL))


@pytest.mark.parametrize("versions", [("_mview_update_time",), ("line", "_mview_update_time"), ()])
def test_the_newer_row_wins_and_rows_move_once(spark, tmp_path, versions):
    path = str(tmp_path / "fact")
    daily.write_fact(rows(spark, ("a", 1, "old", 1), ("b", 1, "old", 5), ("c", 2, "old", None), ("d", 2, "old", 3),
                          ("e", 2, "old", 3), (None, 2, "old", 3), ("far", 4, "old", 3)).drop("start_month"), path)
    new = rows(spark, ("a", 3, "new", 2), ("b", 3, "new", 4), ("c", 2, "new", 1), ("d", 2, "new", None), ("e", 2, "new", 3),
               (None, 2, "new", 3), ("f", 3, "new", 1))
    staged = []

    def stage(df):
        staged.append(df.columns)
        at = str(tmp_path / f"stage{len(staged)}")
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    merge = daily.merge_fact(path, new, versions, stage)
    got = sorted(((r.task_id, r.line, r.start_month) for r in merge.rows.collect()), key=str)
    # By line "old" beats "new"; without versions the change wins.
    old = {("_mview_update_time",): {"b", "d"}, ("line", "_mview_update_time"): {"a", "b", "c", "d", "e"}, (): set()}[versions]
    home = {"a": "202501", "b": "202501", "c": "202502", "d": "202502", "e": "202502"}
    moved = {"a": "202503", "b": "202503", "c": "202502", "d": "202502", "e": "202502"}
    expected = [(t, "old", home[t]) if t in old else (t, "new", moved[t]) for t in home]
    expected += [("f", "new", "202503"), (None, "old", "202502"), (None, "new", "202502")]
    assert got == sorted(expected, key=str) and merge.months == ["202501", "202502", "202503"]
    # Besides the decision: stored rows that stay and, where a change is beaten, the changes that are left.
    assert sum("line" in columns for columns in staged) == 1 + bool(old)
    assert {"task_id", "_stays"} < set(staged[0]) and "line" not in staged[0]
    dates = sorted(str(r.task_start_date) for r in merge.versions.collect())
    assert len(dates) == 5 + 7 and dates.count("2025-04-01") == 0
