import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import classify, dimensions, filters, rollups, variables, versions


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_by_key_takes_the_highest_version_and_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30), ("b", 1, 40), ("c", None, 1)], "k string, v int, x int")
    newest = versions.latest_by_key(df, ["k"], ["v"], ["x"])
    assert rows(newest) == [("a", 2, 20), ("b", 1, 40), ("c", None, 1)]
    once = rows(versions.latest_by_key(df, ["k"], ["v"]))
    again = rows(versions.latest_by_key(df.repartition(7), ["k"], ["v"]))
    assert once == again


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = versions.latest_by_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_newest_value_skips_nulls(spark):
    df = spark.createDataFrame([("p", "x", "a", 1), ("p", "x", None, 2), ("p", "y", "b", None)], "k string, n string, v string, r int")
    out = df.groupBy("k").agg(
        versions.newest_value(F.col("v"), F.col("r"), F.col("n") == "x").alias("x"),
        versions.newest_value(F.col("v"), F.col("r"), F.col("n") == "y").alias("y"),
    ).first()
    assert (out.x, out.y) == ("a", None)


def test_set_states_union_over_bucket_borders(spark):
    ids = spark.range(0, 100_000, 7).withColumn("g", F.col("id") % 2)
    states = {"all": F.lit(True), "big": F.col("id") > 50_000}
    split = versions.set_states(ids, ["g"], "id", states)
    doubled = versions.merge_states(split.unionByName(split), ["g"], ["all", "big"])
    counted = {r.g: (r["all"], r.big) for r in versions.state_counts(doubled, ["g"], ["all", "big"]).collect()}
    expected = {g: (len(s := [i for i in range(0, 100_000, 7) if i % 2 == g]), sum(i > 50_000 for i in s)) for g in (0, 1)}
    assert counted == expected


def test_exclusion_flag_overwrites_the_reason(spark):
    fact = spark.createDataFrame([("t1", 0, ""), ("t2", 1, "bypass"), ("t3", 0, "")], "task_id string, is_excluded int, exclude_reason string")
    variables_ = spark.createDataFrame(
        [("t1", "autoComplete", 1), ("t1", "autoComplete", 1), ("t2", "autoComplete", 1), ("t3", "autoComplete", 0), (None, "autoComplete", 1)],
        "TASK_ID_ string, NAME_ string, LONG_ bigint")
    assert rows(versions.apply_exclusion_flag(fact, variables_)) == [
        ("t1", 1, "autoComplete_flag"), ("t2", 1, "autoComplete_flag"), ("t3", 0, "")]


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, p int")
    assert rows(versions.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert rows(versions.duplication_ratio(df, ["k"], F.lit("x"))) == [("x", 3, 2, 1.5)]


VAR = "PROC_INST_ID_ string, TASK_ID_ string, NAME_ string, TEXT_ string, REV_ int, LONG_ bigint, CREATE_TIME_ timestamp_ntz"


def test_variable_pivot_and_empty_row_guard(spark):
    at = dt.datetime(2025, 6, 1)
    old = dt.datetime(2023, 1, 1)
    raw = spark.createDataFrame([
        ("p1", None, "plant", "A", 1, None, at), ("p1", None, "plant", "B", 2, None, at), ("p1", None, "plant", None, 3, None, at),
        ("p1", "t", "autoComplete", None, 1, 1, at), ("p2", None, "pallet", "x", 1, None, at),
        ("p3", None, "plant", "C", 1, None, old), ("p4", None, "plant", "D", 1, None, at)], VAR)
    wide = {r.PROC_INST_ID_: r for r in variables.pivot_variables(raw).collect()}
    assert wide["p1"].varinst_plant == "B" and wide["p1"].varinst_autoComplete == "true" and wide["p1"].varinst_region == ""
    assert "p2" not in wide and "p3" in wide
    active = spark.createDataFrame([("p1",), ("p1",), ("p3",)], "PROC_INST_ID_ string")
    every_age = variables.pivot_variables(raw, active, "2025-06-01", "2025-07-01")
    assert sorted(r.PROC_INST_ID_ for r in every_age.collect()) == ["p1", "p3"]
    windowed = variables.pivot_variables(raw, active, "2025-06-01", "2025-07-01", lookback_days=365)
    assert [r.PROC_INST_ID_ for r in windowed.collect()] == ["p1"]


LEVELS = ("line_name string, line_desc string, prod_area_code string, factory_code string, factory_name string, "
          "plant_code string, plant_name string, region_code string, region_name string")


def test_levels_fall_back_in_order_and_never_multiply(spark):
    five = spark.createDataFrame([
        ("L1", "", "", "FB", "", "PA", "PA", "S2", ""), ("L1", "", "", "FA", "", "PA", "PA", "S1", ""),
        ("L1", "", "", "", "", "PA", "PA", "S0", ""), ("", "", "", "FX", "", "", "", "SX", "")], LEVELS)
    empty = {f"varinst_{v}": "" for v in variables.VARIABLES}
    pivot = spark.createDataFrame([
        {**empty, "PROC_INST_ID_": "exact", "varinst_plant": "PA", "varinst_lineName": "L1"},
        {**empty, "PROC_INST_ID_": "fallback", "varinst_plant": "PA", "varinst_lineName": "L9"},
        {**empty, "PROC_INST_ID_": "own", "varinst_plant": "PA", "varinst_lineName": "L1", "varinst_region": "R", "varinst_factory": "F"},
        {**empty, "PROC_INST_ID_": "none", "varinst_moNumber": "5"}])
    got = {r.PROC_INST_ID_: (r.region, r.plant, r.factory, r.line) for r in dimensions.resolve_levels(pivot, five).collect()}
    assert got == {"exact": ("S1", "PA", "FA", "L1"), "fallback": ("S0", "PA", "", "L9"),
                   "own": ("R", "PA", "F", "L1"), "none": ("", "", "", "")}


@pytest.mark.parametrize("key, order, factory, expected", [
    ("V3_x", "5", "NPE", "V1"), ("V2_x", "5", "NPE", "V2"), ("V3_x", "1991", "F", "V1"), ("V1_x", "5", "F", "V1"),
    ("V3_x", "5", "F", "V3"), ("X9_y", "5", "F", "X9"), (None, "5", "F", "Unknown"), (None, "5", "NPE", "Unknown")])
def test_vx_rules(spark, key, order, factory, expected):
    df = spark.createDataFrame([(key, order, factory)], "k string, o string, f string")
    assert df.select(classify.classify_vx(F.col("k"), F.col("o"), F.col("f")).alias("v")).first()["v"] == expected


@pytest.mark.parametrize("row, reason", [
    ((1, "SYSTEM", "E1", "Q", "Notify"), "bypass"), ((None, "SYSTEM", "E1", "Q", "Notify"), "system_bypass"),
    ((0, "Ann", "C1", "Q", "Notify"), "system_node"), ((None, None, "V1", "Q1", "Notify"), "Q_order"),
    ((None, None, None, "R1", "x"), "R_order"), ((None, None, None, "", "a Notify b"), "notify_task"),
    ((None, None, None, "", "Dummy"), "dummy_task"), ((None, None, None, "", None), "")])
def test_first_exclusion_rule_wins(spark, row, reason):
    df = spark.createDataFrame([row], "a int, n string, k string, o string, t string")
    label = classify.exclusion_reason(*[F.col(c) for c in "ankot"])
    got = df.select(label.alias("r"), classify.is_excluded(label).alias("x")).first()
    assert (got.r, got.x) == (reason, int(reason != ""))


def test_filters(spark, make_tasks):
    tasks = make_tasks(("a", "2025-12-25", None, None), ("b", "2025-12-25", "2025-12-25", "2025-12-26"),
                       ("c", "2025-12-25", "2025-12-25", "2025-12-25"), ("d", "2025-12-24", "2025-12-25", "2025-12-25", "P2"))

    def ids(df):
        return sorted(r.task_id for r in df.collect())

    assert ids(filters.status_on_day(tasks, "2025-12-25", "todo")) == ["a"]
    assert ids(filters.status_on_day(tasks, "2025-12-25", "doing")) == ["b"]
    assert ids(filters.status_on_day(tasks, "2025-12-25", "done")) == ["c"]
    assert ids(filters.status_on_day(tasks, "2025-12-25")) == ["a", "b", "c"]
    assert ids(filters.filter_dims(tasks, plant="P2", region="ALL", line="")) == ["d"]
    with pytest.raises(ValueError):
        filters.filter_dims(tasks, colour="red")
    with pytest.raises(ValueError):
        filters.status_on_day(tasks, "2025-12-25", "lost")
    moved = make_tasks(("m", "2026-02-10", "2026-03-01", "2026-04-02"))
    assert ids(filters.touching_month(moved, "2026-03", "2026-04-01")) == ["m"]
    assert ids(filters.touching_month(moved, "2026-04", "2026-04-01")) == []


def test_users_and_latest_sums(spark, make_tasks):
    tasks = make_tasks(("a", "2025-12-25", None, None), ("b", "2025-12-25", "2025-12-25", "2025-12-25"))
    from cohortmill.operators.facts import add_statuses
    row = rollups.user_utilization(add_statuses(tasks, "assignee_code")).first()
    assert (row.active_users, row.working_users, row.completed_users, row.total_tasks, row.done_tasks) == (1, 1, 1, 2, 1)
    assert (row.utilization_rate, row.tasks_per_user) == (100.0, 2.0)
    df = spark.createDataFrame([("m", "x", 1, 5, 7), ("m", "x", 2, 5, 9), ("m", "y", 1, 1, 100)], "m string, p string, d int, t int, acc int")
    assert rows(rollups.latest_then_sum(df, ["m"], ["p"], "d", ["t"], ["acc"])) == [("m", 11, 109)]
