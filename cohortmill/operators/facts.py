"""The task fact: one row per task with times, statuses, levels, variables and exclusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.status import cohort_status, live_status
from cohortmill.functions.values import minutes_between, null_if_epoch
from cohortmill.operators.classify import classify_vx, exclusion_reason, is_excluded
from cohortmill.operators.dimensions import resolve_levels
from cohortmill.operators.variables import TEXT_VARIABLES
from cohortmill.operators.versions import latest_by_key

BRONZE_VERSION = ("_sync_version", "_extracted_at")
SOURCE_VERSION = ("LAST_UPDATED_TIME_", "REV_")
TASK_KEYS = ("PROC_INST_ID_", "ID_")
TASK_COLUMNS = ("PROC_DEF_ID_", "TASK_DEF_KEY_", "NAME_", "ASSIGNEE_", "START_TIME_", "CLAIM_TIME_", "END_TIME_")

# Fact column -> variable it comes from.
BUSINESS_COLUMNS = {
    "mo_number": "moNumber", "model_name": "modelName", "delivery_area": "deliveryArea",
    "schedule_number": "scheduleNumber", "sap_plant": "sapPlant", "sap_product_group": "sapProductGroup",
    "pallet": "pallet", "transfer_no": "transferNo", "qblock_event_id": "qBlockEventId", "defect_sn": "defectSn",
}

FACT_COLUMNS = (
    "task_id", "proc_inst_id", "l4_process_id", "l4_process_name", "task_definition_key", "task_name",
    "task_start_time", "task_claim_time", "task_end_time", "task_start_date", "task_claim_date", "task_end_date",
    "task_primary_date", "task_create_date", "duration_min", "processing_time_min", "ui_time_field",
    "task_status", "status_daily", "status_weekly", "status_monthly",
    "vx_type", "region", "plant", "factory", "line", *BUSINESS_COLUMNS,
    "is_excluded", "exclude_reason", "assignee_code", "assignee_name", "_mview_update_time",
)


def add_task_times(df: DataFrame) -> DataFrame:
    """Times with the 1970 sentinel removed, their dates, and durations in minutes."""
    times = (
        df.withColumn("task_start_time", F.col("START_TIME_"))
        .withColumn("task_claim_time", null_if_epoch(F.col("CLAIM_TIME_")))
        .withColumn("task_end_time", null_if_epoch(F.col("END_TIME_")))
        .withColumn("task_start_date", F.to_date("START_TIME_"))
        .withColumn("task_claim_date", null_if_epoch(F.to_date("CLAIM_TIME_")))
        .withColumn("task_end_date", null_if_epoch(F.to_date("END_TIME_")))
        .withColumn("task_primary_date", F.col("task_start_date"))
        .withColumn("task_create_date", F.col("task_start_date"))
    )
    ended = F.col("task_end_date").isNotNull()
    claimed = F.col("task_claim_date").isNotNull()
    return (
        times
        .withColumn("duration_min", F.when(ended, minutes_between(F.col("START_TIME_"), F.col("END_TIME_"))))
        .withColumn("processing_time_min",
                    F.when(ended & claimed, minutes_between(F.col("CLAIM_TIME_"), F.col("END_TIME_"))))
    )


def add_statuses(df: DataFrame, assignee: str = "ASSIGNEE_") -> DataFrame:
    """Live status and the three cohort statuses."""
    return (
        df.withColumn("task_status", live_status(F.col("task_end_date"), F.col(assignee)))
        .withColumn("status_daily", cohort_status("Day"))
        .withColumn("status_weekly", cohort_status("Week"))
        .withColumn("status_monthly", cohort_status("Month"))
    )


def auto_complete_flags(variables: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """One row per task with an autoComplete variable: 1 if any of its rows says so."""
    rows = variables.where((F.col("NAME_") == "autoComplete") & (F.col("TASK_ID_") != ""))
    if tasks is not None:
        rows = rows.join(tasks.select(F.col("ID_").alias("TASK_ID_")).distinct(), "TASK_ID_", "left_semi")
    return rows.groupBy("TASK_ID_").agg(F.max(F.when(F.col("LONG_") == 1, 1).otherwise(0)).alias("auto_complete"))


def _newest(log: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """Newest version of the columns that are used; selecting them first keeps the others out of scan and shuffle."""
    return latest_by_key(log.select(*keys, *columns, *BRONZE_VERSION), keys, BRONZE_VERSION)


def process_attributes(pivot: DataFrame, five_level: DataFrame, procinst: DataFrame) -> DataFrame:
    """Everything a task inherits from its process, one row per process.

    Built before tasks are joined, so the join on the process key - the one that can be skewed - happens once
    and has a unique right side; Spark may then split a hot process on the task side (AQE skew join).
    """
    resolved = resolve_levels(pivot, five_level)
    instances = _newest(procinst, ["ID_"], ["BUSINESS_STATUS_"]).select(
        F.col("ID_").alias("PROC_INST_ID_"), F.col("BUSINESS_STATUS_").alias("l4_process_id")
    )
    return resolved.join(instances, "PROC_INST_ID_", "full")


def build_task_fact(
    *,
    tasks: DataFrame,
    pivot: DataFrame,
    five_level: DataFrame,
    procinst: DataFrame,
    procdef: DataFrame,
    employees: DataFrame,
    variables: DataFrame,
    updated_at,
    only: DataFrame | None = None,
    flag_reason: str = "bypass",
) -> DataFrame:
    """Assemble the fact for the tasks of ``only`` (columns of TASK_KEYS, distinct), or for all tasks.

    Every right side is made unique first, so no join multiplies tasks. ``only`` names ids, not versions: the newest
    version of a task may lie outside the window that an older one touches. ``flag_reason`` is the reason of tasks with
    autoComplete, the first rule: the label of the later exclusion phase here saves that phase its scan and join.
    """
    log = tasks.where(F.col("ID_") != "")
    if only is not None:
        # Not a semi join: Spark would push it into every part of a log that is a union and sort both sides there once more.
        # The newest version per key takes one row, so keys named twice would do no harm.
        log = log.join(only, list(TASK_KEYS))
        processes = only.select("PROC_INST_ID_").distinct()
        procinst = procinst.join(processes.withColumnRenamed("PROC_INST_ID_", "ID_"), "ID_", "left_semi")
    # Versions loaded together are told apart by the source's own update time and revision, where it has them.
    source_order = [c for c in SOURCE_VERSION if c in log.columns]
    newest = latest_by_key(
        log.select(*TASK_KEYS, *TASK_COLUMNS, *BRONZE_VERSION, *source_order), TASK_KEYS, (*BRONZE_VERSION, *source_order)
    )

    definitions = _newest(procdef, ["ID_"], ["NAME_"]).select(
        F.col("ID_").alias("PROC_DEF_ID_"), F.col("NAME_").alias("l4_process_name")
    )
    people = _newest(employees, ["EmpCode"], ["EmpName"]).select(
        F.col("EmpCode").alias("ASSIGNEE_"), F.col("EmpName").alias("assignee_name")
    )
    flags = auto_complete_flags(variables, only).withColumnRenamed("TASK_ID_", "ID_")

    joined = (
        newest.join(process_attributes(pivot, five_level, procinst), "PROC_INST_ID_", "left")
        .join(definitions, "PROC_DEF_ID_", "left")
        .join(people, "ASSIGNEE_", "left")
        .join(flags, "ID_", "left")
    )
    blank = F.lit("")
    text = {v: F.coalesce(F.col(f"varinst_{v}"), blank) for v in TEXT_VARIABLES}
    levels = {c: F.coalesce(F.col(c), blank) for c in ("region", "plant", "factory", "line")}
    key = F.col("TASK_DEF_KEY_")
    reason = exclusion_reason(
        F.col("auto_complete"), F.col("assignee_name"), key, text["moNumber"], F.col("NAME_"), flag_reason
    )
    shaped = add_statuses(add_task_times(joined)).withColumns({
        "task_id": F.col("ID_"),
        "proc_inst_id": F.coalesce(F.col("PROC_INST_ID_"), blank),
        "l4_process_id": F.coalesce(F.col("l4_process_id"), blank),
        "l4_process_name": F.coalesce(F.col("l4_process_name"), blank),
        "task_definition_key": F.coalesce(key, blank),
        "task_name": F.coalesce(F.col("NAME_"), blank),
        "ui_time_field": text["time"],
        "vx_type": classify_vx(key, text["moNumber"], levels["factory"]),
        **levels,
        **{column: text[variable] for column, variable in BUSINESS_COLUMNS.items()},
        "exclude_reason": reason,
        "is_excluded": is_excluded(reason),
        "assignee_code": F.coalesce(F.col("ASSIGNEE_"), blank),
        "assignee_name": F.coalesce(F.col("assignee_name"), blank),
        "_mview_update_time": F.lit(updated_at).cast("timestamp_ntz"),
    })
    return shaped.select(*FACT_COLUMNS)
