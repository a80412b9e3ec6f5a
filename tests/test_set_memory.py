"""Bitmaps: ids travel to them, and stored ones are dealt by their number, shuffled and sorted once."""

import datetime as dt

from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.operators import task_sets
from cohortmill.operators.versions import set_states


def test_daily_sets_are_dealt_by_their_number_and_shuffled_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(task_sets, "SETS_PER_TASK", 8)
    rows = spark.range(400).select("id", F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 40).cast("int")).alias("snapshot_date"),
                                   *[F.lit("x").alias(c) for c in DIMENSIONS])
    path = str(tmp_path / "sets")
    set_states(rows, ["snapshot_date", *DIMENSIONS], "id", {task_sets.OPENED: F.lit(True)}).write.parquet(path)
    sets = task_sets.backlog_sets(spark.read.parquet(path), "Month")
    physical = sets._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1 and physical.count(" Sort [") == 1
    assert sets.rdd.getNumPartitions() == 1 + 2 * 40 // 8


def test_ids_travel_to_their_bitmaps(spark):
    ids = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    sets = set_states(ids, ["g"], "id", {"all": F.lit(True)})
    physical = sets._jdf.queryExecution().executedPlan().toString()
    below = physical.split("Exchange hashpartitioning")[1]
    assert "bitmap_construct_agg" not in below
