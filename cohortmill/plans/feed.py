"""Change feed of master data: which keys of a table differ from what the fact was built from, and the tasks they reach.

A fact row depends on more than its task: on the definition of its process, its assignee and the organisation levels. These
tables are loaded whole, so what changed is not in the load. The feed keeps, per key, a hash of the columns the fact uses as
of the last build; the hashes of the current version are grouped with them, one shuffle of keys, and keys whose hash
differs or that came or went are mapped to tasks. Null keys and blank ones reach no task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.operators.dimensions import one_row_per_line, region_of_plant
from cohortmill.operators.facts import BRONZE_VERSION, TASK_KEYS
from cohortmill.operators.versions import latest_by_key
from cohortmill.plans.daily import Bronze

# Feed -> key columns, in the tables of ``states``.
KEYS = {
    "definitions": ("ID_",), "people": ("EmpCode",), "lines": ("plant_code", "line_name"), "plants": ("plant_code",),
}
STATE_DDL = {feed: ", ".join(f"{k} string" for k in keys) + ", digest bigint" for feed, keys in KEYS.items()}


def _hashed(df: DataFrame, feed: str, columns: Sequence[str]) -> DataFrame:
    keys = KEYS[feed]
    for key in keys:
        df = df.where(F.col(key) != "")
    return df.select(*keys, F.xxhash64(*[F.coalesce(F.col(c), F.lit("")) for c in columns]).alias("digest"))


def states(bronze: Bronze, levels: DataFrame) -> dict[str, DataFrame]:
    """Per feed one row per key: the key and a hash of what the fact takes from it."""
    definitions = latest_by_key(bronze.procdef.select("ID_", "NAME_", *BRONZE_VERSION), ["ID_"], BRONZE_VERSION)
    people = latest_by_key(bronze.employees.select("EmpCode", "EmpName", *BRONZE_VERSION), ["EmpCode"], BRONZE_VERSION)
    return {
        "definitions": _hashed(definitions, "definitions", ["NAME_"]),
        "people": _hashed(people, "people", ["EmpName"]),
        "lines": _hashed(one_row_per_line(levels), "lines", ["factory_code", "region_code"]),
        "plants": _hashed(region_of_plant(levels), "plants", ["region_code"]),
    }


def changed_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that came, went or have another digest; both sides have unique keys."""
    sides = before.select(*keys, F.col("digest").alias("old"), F.lit(None).cast("bigint").alias("new")).unionByName(
        after.select(*keys, F.lit(None).cast("bigint").alias("old"), F.col("digest").alias("new")))
    both = sides.groupBy(*keys).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys)


def reached_tasks(changed: Mapping[str, DataFrame], fact: DataFrame, tasks: DataFrame) -> DataFrame:
    """``TASK_KEYS`` of the tasks that changed keys reach.

    A fact row has its assignee and, as they were given, its plant and line; the definition is in the task log alone. Tasks
    that are not in the fact yet are new and come by the log. The lists of changed keys are small as a rule, so Spark
    broadcasts them at run time; a changed key that holds very many tasks is only the larger side of a semi join.
    """
    keys = [F.col("proc_inst_id").alias("PROC_INST_ID_"), F.col("task_id").alias("ID_")]
    found = []
    on_fact = {"people": {"EmpCode": "assignee_code"}, "lines": {"plant_code": "plant", "line_name": "line"},
               "plants": {"plant_code": "plant"}}
    for feed, columns in on_fact.items():
        if feed in changed:
            of_feed = changed[feed].select(*[F.col(k).alias(c) for k, c in columns.items()])
            found.append(fact.select("proc_inst_id", "task_id", *columns.values()).join(
                of_feed, list(columns.values()), "left_semi").select(*keys))
    if "definitions" in changed:
        of_feed = changed["definitions"].withColumnRenamed("ID_", "PROC_DEF_ID_")
        found.append(tasks.select(*TASK_KEYS, "PROC_DEF_ID_").join(of_feed, "PROC_DEF_ID_", "left_semi").select(*TASK_KEYS))
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole.distinct()
