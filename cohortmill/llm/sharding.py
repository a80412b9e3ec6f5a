"""Sharding by global byte-size prefix sums: totals per partition, then cuts at equal targets.

Rows are put in one global order (id, then content hash) by range partitions. Each partition sums its own sizes; the totals
of the partitions, one row each, are summed up to the bytes in front of every partition. A row's place in the whole is the
sum of both, and its shard is the equal share of all bytes in which its middle byte lies: shards are contiguous in the
order and differ from the target by less than the rows at their two ends. The narrow rows (id, size, hash) are shuffled,
texts never; a text that is copied into a third of all rows, or an id that is, spreads over range partitions because the
row's position in the input is the last sort key.

Defined cases: a null text has no bytes, so size 1, and the CRC of no bytes; a null id sorts first; repeated rows are
placed one after the other; an empty table gives an empty result; a row larger than a share leaves the shards it covers
empty but for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortmill.llm.staging import staged


def ranked(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """``df`` in a global order with ``rank`` (from 0) and ``before`` (sum of ``size`` in front of the row)."""
    keys = [*order, "__input"]
    placed = df.withColumn("__input", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = placed.withColumn("__at", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__at", 33))
    placed = staged(placed.drop("__input"), name)

    totals = placed.groupBy("__part").agg(F.sum(size).alias("__sum"), F.count("*").alias("__rows"))
    # One row per partition: a window over all of them is as small as the number of tasks.
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        totals.select(
            "__part", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__sum_before"),
            F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__rows_before"),
        ),
        name + "-offsets",
    )
    within = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__own", F.coalesce(F.sum(size).over(within), F.lit(0)))
        .withColumn("__nth", F.row_number().over(Window.partitionBy("__part").orderBy("__at")) - 1)
        .join(offsets, "__part")
        .withColumn("before", F.col("__sum_before") + F.col("__own"))
        .withColumn("rank", F.col("__rows_before") + F.col("__nth"))
        .drop("__part", "__at", "__own", "__nth", "__sum_before", "__rows_before")
    )


def balanced_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size (UTF-8 bytes of the text plus 1), text_crc32, shard (0 to shards - 1), slot (gapless in the shard)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = ranked(narrow, ["id", "text_crc32", "size"], "size", "sharding")
    total = narrow.agg(F.sum("size")).first()[0] or 1
    share = F.expr(f"cast((before * 2 + size) * {shards} div {2 * total} as int)")
    cut = staged(placed.withColumn("shard", F.least(share, F.lit(shards - 1))), "shards")
    first = cut.groupBy("shard").agg(F.min("rank").alias("__first"))
    return cut.join(F.broadcast(first), "shard").select(  # one row per shard
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("rank") - F.col("__first")).alias("slot"))
