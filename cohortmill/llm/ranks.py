"""Positions of rows within their groups, whatever the sizes of the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cohortmill.llm.staging import staged


def placed(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``place`` (from 0, by ``order`` within its ``group``) and ``n`` (rows of the group).

    Rows are put in one order by range partitions, so a group that holds a third of all rows spreads over many tasks;
    its pieces, at most one per partition, are counted, and a place is the rows of the pieces in front plus the place
    in the own piece. Equal rows are placed one after the other: the position in the input is the last sort key, so
    copies of one row spread as well. ``group`` must not be null.
    """
    keys = [group, *order, "__input"]
    rows = df.withColumn("__input", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = staged(rows.drop("__input").withColumn("__at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    pieces = rows.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    ahead = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = staged(pieces.select(
        group, "__part", "__first", F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__before"),
        F.sum("__rows").over(Window.partitionBy(group)).alias("n"),
    ), name + "-pieces")
    return (
        rows.join(pieces, [group, "__part"])
        .withColumn("place", F.col("__at") - F.col("__first") + F.col("__before"))
        .drop("__at", "__part", "__first", "__before")
    )


def in_blocks(rows: DataFrame, group: str, span: int, *order: str) -> DataFrame:
    """``rows`` with ``block`` (``place`` in units of ``span``), each block of a group whole and in order in one partition."""
    blocks = rows.withColumn("block", F.expr(f"place div {span}"))
    return blocks.repartition(group, "block").sortWithinPartitions(group, "block", *order)
