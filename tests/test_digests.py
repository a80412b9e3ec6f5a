import random

import pytest
from pyspark.sql import functions as F

from cohortmill.plans import digests, recon

DDL = "a int, b string, t timestamp_ntz"


def pair(spark, seed, n=400):
    rng = random.Random(seed)
    source = [(rng.choice([None, *range(n)]), rng.choice([None, "", "x", "y"]), None) for _ in range(n)]
    target = [r for r in source if rng.random() > 0.05] + [(n + k, "z", None) for k in range(3)]
    target += rng.sample(target, 5)
    return spark.createDataFrame(source, DDL), spark.createDataFrame(target, DDL).withColumn("a", F.col("a").cast("bigint"))


@pytest.mark.parametrize("cut", [{}, {"bits": 2, "rows": 10}, {"bits": 3, "rows": 0}])
def test_digests_find_what_a_full_comparison_finds(spark, cut):
    source, target = pair(spark, 3)
    keys = ["a", "b"]
    want = recon.missing_keys(source, target, keys, "t")
    got = digests.missing_by_digest(source, target, keys, "t", **cut)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0
    row = digests.reconcile_by_digest(source, target, keys, "t", **cut).first()
    counts = recon.reconcile_counts(source, target, keys, "t").first()
    assert (row.source_rows, row.target_rows, row.keys_not_in_target) == (
        counts.source_rows, counts.target_rows, counts.keys_not_in_target)
    assert row.keys_not_in_source == recon.missing_keys(target, source, keys).count() == 3


def test_only_ranges_that_differ_are_compared(spark):
    source = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    target = source.where("k <> '77'")
    row = digests.reconcile_by_digest(source, target, ["k"], "t").first()
    assert (row.keys_not_in_target, row.keys_not_in_source, row.ranges) == (1, 0, 1) and row.compared_rows < 40
    deeper = digests.reconcile_by_digest(source, target, ["k"], "t", bits=4, rows=50).first()
    assert deeper.levels == 3 and deeper.keys_not_in_target == 1 and deeper.compared_rows < 40
    equal = digests.reconcile_by_digest(source, source, ["k"], "t").first()
    assert (equal.ranges, equal.compared_rows, equal.keys_not_in_target) == (0, 0, 0)


def test_nulls_and_repeats_count_in_a_digest(spark):
    ddl = "a string, b string"
    swapped = [spark.createDataFrame([x], ddl) for x in ((None, "x"), ("x", None))]
    assert digests.reconcile_by_digest(*swapped, ["a", "b"], "t").first().keys_not_in_target == 1
    once, twice = (spark.createDataFrame([("x", None)] * n, ddl) for n in (1, 3))
    row = digests.reconcile_by_digest(once, twice, ["a", "b"], "t").first()
    assert (row.ranges, row.keys_not_in_target, row.source_rows, row.target_rows) == (1, 0, 1, 3)
    none = once.where("false")
    assert digests.missing_by_digest(none, none, ["a", "b"]).isEmpty()
