"""The pivot of variables: a log that is a union is joined once, and what is sorted is narrow."""

import datetime as dt

from pyspark.sql import functions as F

from cohortmill.operators import variables

VARIABLE_DDL = "PROC_INST_ID_ string, TASK_ID_ string, NAME_ string, TEXT_ string, REV_ int, LONG_ bigint, CREATE_TIME_ timestamp_ntz"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def part(spark, name):
    return spark.range(40).select(
        F.concat(F.lit("P"), "id").alias("PROC_INST_ID_"), F.concat(F.lit("T"), "id").alias("TASK_ID_"), F.lit(name).alias("NAME_"),
        F.concat(F.lit(name), "id").alias("TEXT_"), F.lit(1).alias("REV_"), F.lit(1).cast("bigint").alias("LONG_"),
        F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("CREATE_TIME_"))


def union_log(spark):
    log = part(spark, "plant")
    for name in ("region", "factory", "lineName", "modelName"):
        log = log.union(part(spark, name))
    return log


def test_a_log_of_many_parts_is_joined_with_the_active_processes_once(spark):
    active = spark.range(30).select(F.concat(F.lit("P"), F.col("id") % 7).alias("PROC_INST_ID_"))
    wide = variables.pivot_variables(union_log(spark), active)
    assert plan_of(wide).count("Join ") == 1
    rows = {r.PROC_INST_ID_: r for r in wide.collect()}
    assert sorted(rows) == [f"P{k}" for k in range(7)]
    assert rows["P3"].varinst_plant == "plant3" and rows["P3"].varinst_modelName == "modelName3" and rows["P3"].varinst_time == ""


def test_nulls_and_ties_of_a_pivot(spark):
    rows = [("P1", None, "plant", None, 3, None), ("P1", None, "plant", "a", 2, None), ("P1", None, "plant", "b", 2, None),
            ("P1", None, "region", "r", None, None), ("P1", None, "autoComplete", None, 1, 0), ("P2", None, "plant", None, 1, None),
            ("P3", None, "plant", "", 1, None), (None, None, "plant", "x", 1, None)]
    log = spark.createDataFrame([(*r, None) for r in rows], VARIABLE_DDL)
    wide = {r.PROC_INST_ID_: r for r in variables.pivot_variables(log).collect()}
    assert sorted(wide, key=str) == [None, "P1"] and wide["P1"].varinst_plant == "b"
    assert wide["P1"].varinst_region == "" and wide["P1"].varinst_autoComplete == "false"
    assert [r.PROC_INST_ID_ for r in variables.pivot_variables(log, log.select("PROC_INST_ID_")).collect()] == ["P1"]
