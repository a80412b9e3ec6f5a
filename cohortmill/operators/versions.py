"""Latest-version, distinct-set and update semantics over append-only tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    version_cols: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row per key.

    ``row_number() = 1`` lets Spark put a group limit in front of the shuffle, so a hot key sends one
    row per input partition, not all its versions. Ties end on a hash of the whole row by default.
    """
    order = [F.col(c).desc_nulls_last() for c in version_cols]
    if tie_break is None:
        order.append(F.xxhash64(*df.columns).desc())
    else:
        order += [F.col(c).desc_nulls_last() for c in tie_break]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def newest_value(value: Column, version: Column, where: Column | None = None) -> Column:
    """Aggregate: value of the highest version, skipping NULL values and NULL versions.

    Two values under one version resolve to the larger value, so the result never depends on order.
    """
    usable = value.isNotNull() & version.isNotNull()
    if where is not None:
        usable = where & usable
    return F.max(F.when(usable, F.struct(version.alias("version"), value.alias("value"))))["value"]


def argmax_by_key(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str], version: str) -> DataFrame:
    """Per key and per column, the newest non-null value."""
    return df.groupBy(*keys).agg(
        *[newest_value(F.col(c), F.col(version)).alias(c) for c in value_cols]
    )


def first_by_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """First row per key in ascending order."""
    first = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def set_states(
    df: DataFrame, keys: Sequence[str], id_col: str, states: Mapping[str, Column]
) -> DataFrame:
    """Persistable distinct sets: one bitmap per key, id bucket and named state.

    A bucket covers 32,768 consecutive ids and takes 4 KB, so a group of any size stays spread over
    rows. Ids must be dense non-negative integers; do not feed 64-bit hashes. Ids travel, not half-filled
    bitmaps: a task sorts narrow rows and builds one bitmap after the other.
    """
    named = df.select(*keys, F.bitmap_bucket_number(id_col).alias("id_bucket"), F.bitmap_bit_position(id_col).alias("_bit"),
                      *[cond.alias(f"_in_{name}") for name, cond in states.items()])
    return (
        named.repartition(*keys, "id_bucket").groupBy(*keys, "id_bucket")
        .agg(*[F.bitmap_construct_agg(F.when(F.col(f"_in_{name}"), F.col("_bit"))).alias(name) for name in states])
    )


def merge_states(df: DataFrame, keys: Sequence[str], state_cols: Sequence[str]) -> DataFrame:
    """Union the sets of rows that share key and bucket."""
    return df.groupBy(*keys, "id_bucket").agg(*[F.bitmap_or_agg(c).alias(c) for c in state_cols])


def state_counts(df: DataFrame, keys: Sequence[str], state_cols: Sequence[str]) -> DataFrame:
    """Exact cardinality of every merged set per key."""
    return df.groupBy(*keys).agg(*[F.sum(F.bitmap_count(c)).alias(c) for c in state_cols])


# Fixed value: the reason of the exclusion phase.
FLAG_REASON = "autoComplete_flag"


def apply_exclusion_flag(fact: DataFrame, variables: DataFrame) -> DataFrame:
    """Mark every task that has autoComplete = 1 as excluded; this reason replaces an earlier one."""
    flagged = (
        variables.where((F.col("NAME_") == "autoComplete") & (F.col("LONG_") == 1) & F.col("TASK_ID_").isNotNull())
        .select(F.col("TASK_ID_").alias("task_id")).distinct().withColumn("_flagged", F.lit(True))
    )
    return (
        fact.join(flagged, "task_id", "left")
        .withColumn("is_excluded", F.when(F.col("_flagged"), F.lit(1)).otherwise(F.col("is_excluded")).cast("int"))
        .withColumn("exclude_reason", F.when(F.col("_flagged"), F.lit(FLAG_REASON))
                    .otherwise(F.col("exclude_reason")))
        .select(*fact.columns)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def duplication_ratio(df: DataFrame, keys: Sequence[str], period: Column) -> DataFrame:
    """Rows against distinct keys per period.

    Counted in two grouping steps instead of ``count(distinct)``: a hot period is first spread over its keys.
    """
    per_key = df.groupBy(period.alias("ym"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy("ym").agg(
        F.sum("_n").alias("raw_rows"), F.count(F.lit(1)).alias("distinct_keys")
    ).withColumn("ratio", F.round(F.col("raw_rows") / F.col("distinct_keys"), 4))
