import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.plans import recon


@pytest.mark.parametrize("source, target, missing, shown", [
    (848_876, 848_875, 1, "99.9999%"), (10, 10, 0, "100.00%"), (10, 11, -1, "110.0000%"), (3, 2, 1, "66.6667%")])
def test_only_a_complete_table_shows_100(spark, source, target, missing, shown):
    df = spark.createDataFrame([(target * 100.0 / source, missing)], "p double, m bigint")
    assert df.select(recon.percent_of_target(F.col("p"), F.col("m")).alias("v")).first()["v"] == shown


def pair(spark, source, target):
    ddl = "a int, b string"
    return spark.createDataFrame(source, ddl), spark.createDataFrame(target, ddl)


def test_counts_treat_null_keys_as_equal(spark):
    source, target = pair(spark, [(1, None), (1, None), (2, "x"), (3, "y")], [(1, None), (2, "x"), (2, "x")])
    row = recon.reconcile_counts(source, target, ["a", "b"], "t", unique_in_source=False).first()
    assert (row.source_rows, row.source_keys, row.target_rows, row.target_keys, row.keys_not_in_target, row.missing) == (4, 3, 3, 2, 1, 1)
    absent = recon.missing_keys(source, target, ["a", "b"]).collect()
    assert [(r.a, r.b, r.src_rows) for r in absent] == [(3, "y", 1)]


@pytest.mark.parametrize("source, target, unique, kw, verdict", [
    ([], [(1, "a")], True, {}, "NO_SOURCE_DATA"),
    ([(1, "a")], [(1, "a")], True, {}, "OK"),
    ([(1, "a"), (1, "a")], [(1, "a")], False, {}, "OK_KEY_COLLAPSE"),
    ([(1, "a"), (1, "a")], [(1, "a")], True, {}, "GAP"),
    ([(1, "a"), (2, "a")], [(1, "a")], True, {"tolerance_pct": 50.0}, "OK_BOUNDARY"),
    ([(1, "a")], [(1, "a")], True, {"stale": F.lit}, "STALE"),
    ([(1, "a"), (2, "a")], [(1, "a")], True, {"key_available": F.lit}, "SKIP_NO_KEY")])
def test_verdicts(spark, source, target, unique, kw, verdict):
    kw = {k: (v(k == "stale") if callable(v) else v) for k, v in kw.items()}
    s, t = pair(spark, source, target)
    counts = recon.reconcile_counts(s, t, ["a", "b"], "t", unique)
    assert recon.classify_gap(counts, **kw).first()["verdict"] == verdict


def test_freshness_and_frozen_window(spark):
    times = [(dt.datetime(2026, 1, d, 12),) for d in range(1, 11)]
    source = spark.createDataFrame(times, "t timestamp_ntz")
    target = source.where(F.col("t") < F.lit("2026-01-09").cast("timestamp_ntz"))
    row = recon.freshness_lag(source, target, "t").first()
    assert (row.lag_seconds, row.stale) == (2 * 86400, True)
    assert recon.freshness_lag(source, source, "t").first()["stale"] is False
    assert recon.frozen_window(source, "t", "2026-01-05 12:00:00", days=2).count() == 2
    assert recon.frozen_window(source, "t", "2026-01-05 12:00:00", days=4, history_start="2026-01-04").count() == 1


def test_report_orders_categories_and_adds_a_total(spark, tmp_path):
    source, target = pair(spark, [(1, "a"), (2, "b")], [(1, "a")])
    rows = None
    for table in ("other", "taskinst", "hr_employee"):
        row = recon.classify_gap(recon.reconcile_counts(source, target, ["a", "b"], table))
        rows = row if rows is None else rows.unionByName(row)
    report = recon.reconciliation_report(rows)
    got = [(r.category, r.table, r.source_rows, r.missing, r.pct) for r in report.collect()]
    assert got == [("People and organisation", "hr_employee", 2, 1, "50.0000%"), ("Workflow engine", "taskinst", 2, 1, "50.0000%"),
                   ("Other", "other", 2, 1, "50.0000%"), ("Total", "3 tables", 6, 3, "50.0000%")]
    recon.write_report_csv(report, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4
