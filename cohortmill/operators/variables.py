"""Entity-attribute-value process variables to one wide row per process."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.operators.versions import newest_value

# The variable names that become columns.
TEXT_VARIABLES = (
    "region", "plant", "factory", "lineName", "moNumber", "modelName", "deliveryArea", "scheduleNumber",
    "sapPlant", "sapProductGroup", "pallet", "transferNo", "qBlockEventId", "defectSn", "time",
)
FLAG_VARIABLE = "autoComplete"
VARIABLES = (*TEXT_VARIABLES, FLAG_VARIABLE)
# A process with none of these set carries nothing worth keeping.
REQUIRED_ANY = ("plant", "region", "lineName", "moNumber")


def pivot_variables(
    variables: DataFrame,
    active: DataFrame | None = None,
    lo=None,
    hi=None,
    lookback_days: int | None = None,
) -> DataFrame:
    """Newest revision of each named variable per process, missing ones as ''.

    ``active`` (column PROC_INST_ID_) limits the work to processes touched by the window, with all their revisions.
    ``hi`` leaves out later variables; ``lookback_days`` with ``lo`` those created before ``lo - lookback_days``. The newest
    value of a process and name is found first, on rows that hold one value, and collapses on the map side: a process with
    very many variable rows shuffles one row per name and input partition. Strings make these aggregations sort, so what is
    sorted stays narrow; a wide row is built from at most one row per name.
    """
    rows = variables.where(F.col("NAME_").isin(*VARIABLES))
    if lo is not None and lookback_days is not None:
        rows = rows.where(F.col("CREATE_TIME_") >= F.lit(lo).cast("timestamp_ntz")
                          - F.expr(f"INTERVAL '{int(lookback_days)}' DAY"))
    if hi is not None:
        rows = rows.where(F.col("CREATE_TIME_") < F.lit(hi).cast("timestamp_ntz"))
    flag_text = F.when(F.col("LONG_") == 1, F.lit("true")).otherwise(F.lit("false"))
    value = F.when(F.col("NAME_") == FLAG_VARIABLE, flag_text).otherwise(F.col("TEXT_"))
    # A process without any usable value would be dropped in the end.
    rows = rows.select("PROC_INST_ID_", "NAME_", "REV_", value.alias("value")).where("value is not null and REV_ is not null")
    if active is not None:
        # Not a semi join: Spark would push it into every part of a log that is a union and sort both sides there once more.
        rows = rows.join(active.select("PROC_INST_ID_").distinct(), "PROC_INST_ID_")

    newest = rows.groupBy("PROC_INST_ID_", "NAME_").agg(newest_value(F.col("value"), F.col("REV_")).alias("value"))
    wide = newest.groupBy("PROC_INST_ID_").agg(*[
        F.coalesce(F.max(F.when(F.col("NAME_") == v, F.col("value"))), F.lit("")).alias(f"varinst_{v}") for v in VARIABLES
    ])
    return drop_empty_rows(wide)


def drop_empty_rows(wide: DataFrame) -> DataFrame:
    """Keep a process only if at least one of the required variables is set."""
    return wide.where(F.greatest(*[F.col(f"varinst_{v}") != "" for v in REQUIRED_ANY]))
