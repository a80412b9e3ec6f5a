"""The fact of a window builds wide process rows from one row per process and variable."""

import datetime as dt

from cohortmill.operators import facts, variables
from tests.test_pivot_memory import plan_of, union_log


def test_the_fact_of_a_window_pivots_rows_of_one_value(spark):
    tasks = spark.createDataFrame(
        [(f"P{k}", f"T{k}", "D", "V1", "n", "E", dt.datetime(2025, 1, 2), None, None, 1, dt.datetime(2025, 1, 3)) for k in range(5)],
        "PROC_INST_ID_ string, ID_ string, " + "".join(f"{c} string, " for c in facts.TASK_COLUMNS[:4])
        + "START_TIME_ timestamp_ntz, CLAIM_TIME_ timestamp_ntz, END_TIME_ timestamp_ntz, _sync_version bigint, _extracted_at timestamp_ntz")
    log = union_log(spark)
    pivot = variables.pivot_variables(log, tasks.select("PROC_INST_ID_"))
    levels = spark.createDataFrame([], "plant_code string, line_name string, factory_code string, region_code string")
    version = "_sync_version bigint, _extracted_at timestamp_ntz"
    fact = facts.build_task_fact(
        tasks=tasks, pivot=pivot, five_level=levels, procinst=spark.createDataFrame([], f"ID_ string, BUSINESS_STATUS_ string, {version}"),
        procdef=spark.createDataFrame([], f"ID_ string, NAME_ string, {version}"),
        employees=spark.createDataFrame([], f"EmpCode string, EmpName string, {version}"), variables=log,
        updated_at="2025-02-01", only=tasks.select(*facts.TASK_KEYS))
    aggregates = [line for line in plan_of(fact).splitlines() if "Aggregate [PROC_INST_ID_" in line]
    # The wide one reads groups of process and name, not rows of the log.
    assert sum("NAME_" in line.split("]")[0] for line in aggregates) == 1
    assert sorted((r.task_id, r.plant, r.line) for r in fact.collect()) == [(f"T{k}", f"plant{k}", f"lineName{k}") for k in range(5)]


def test_a_task_log_of_many_parts_is_joined_with_its_keys_once(spark):
    ddl = ("PROC_INST_ID_ string, ID_ string, " + "".join(f"{c} string, " for c in facts.TASK_COLUMNS[:4])
           + "START_TIME_ timestamp_ntz, CLAIM_TIME_ timestamp_ntz, END_TIME_ timestamp_ntz, _sync_version bigint, _extracted_at timestamp_ntz")

    def part(version, name):
        opened = dt.datetime(2025, 1, 2)
        return spark.createDataFrame([(f"P{k}", f"T{k}", "D", "V1", name, "E", opened, None, None, version, opened) for k in range(9)], ddl)

    log, only = part(1, "old").union(part(2, "new")), part(1, "old").where("ID_ < 'T4'").select(*facts.TASK_KEYS)
    version = "_sync_version bigint, _extracted_at timestamp_ntz"
    fact = facts.build_task_fact(
        tasks=log, pivot=variables.pivot_variables(union_log(spark), only.select("PROC_INST_ID_")),
        five_level=spark.createDataFrame([], "plant_code string, line_name string, factory_code string, region_code string"),
        procinst=spark.createDataFrame([], f"ID_ string, BUSINESS_STATUS_ string, {version}"),
        procdef=spark.createDataFrame([], f"ID_ string, NAME_ string, {version}"),
        employees=spark.createDataFrame([], f"EmpCode string, EmpName string, {version}"), variables=union_log(spark),
        updated_at="2025-02-01", only=only.union(only))
    joins = [line for line in plan_of(fact).splitlines() if "Join" in line and "(PROC_INST_ID_#" in line and "(ID_#" in line]
    assert len(joins) == 1
    assert sorted((r.task_id, r.task_name) for r in fact.collect()) == [(f"T{k}", "new") for k in range(4)]
