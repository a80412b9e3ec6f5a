"""Ordered classification and exclusion rules; the first rule that matches wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the business rules.
V1_ORDER_PREFIXES = ("196", "199", "200", "210", "212", "213")
V1_ONLY_FACTORY = "NPE"
SYSTEM_USER = "SYSTEM"


def classify_vx(task_key: Column, order_number: Column, factory: Column) -> Column:
    """V1 / V2 / V3 from factory, order number prefix and task key; else the key's first two letters."""
    return (
        F.when((factory == V1_ONLY_FACTORY) & ~task_key.startswith("V2"), F.lit("V1"))
        .when(F.substring(order_number, 1, 3).isin(*V1_ORDER_PREFIXES), F.lit("V1"))
        .when(task_key.startswith("V1"), F.lit("V1"))
        .when(task_key.startswith("V2"), F.lit("V2"))
        .when(task_key.startswith("V3"), F.lit("V3"))
        .otherwise(F.coalesce(F.substring(task_key, 1, 2), F.lit("Unknown")))
    )


def exclusion_reason(
    auto_complete: Column, assignee_name: Column, task_key: Column, order_number: Column, task_name: Column,
    flag_reason: str = "bypass",
) -> Column:
    """Why a task does not count, or '' when it does."""
    rules = (
        (auto_complete == 1, flag_reason),
        (assignee_name == SYSTEM_USER, "system_bypass"),
        (task_key.startswith("E") | task_key.startswith("C"), "system_node"),
        (order_number.startswith("Q"), "Q_order"),
        (order_number.startswith("R"), "R_order"),
        (task_name.contains("Notify"), "notify_task"),
        (task_name.contains("Dummy"), "dummy_task"),
    )
    (first, label), *others = rules
    chain = F.when(first, F.lit(label))
    for condition, reason in others:
        chain = chain.when(condition, F.lit(reason))
    return chain.otherwise(F.lit(""))


def is_excluded(reason: Column) -> Column:
    return F.when(reason != "", F.lit(1)).otherwise(F.lit(0)).cast("int")
