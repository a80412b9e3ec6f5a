"""Connected components of a link table, by contracting it in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortmill.llm.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of ``links`` (u, v); the component is its smallest id.

    In each round every node takes the name of the neighbour with the smallest hash (its own, if that is smaller), and
    the links are rewritten to the new names. Names by hash shrink any graph, paths of ascending ids too, by a constant
    factor a round in expectation. Each round aggregates before it shuffles and joins staged tables, whose hot keys Spark
    can split; nothing but a row count reaches the driver. Null ends and loops are ignored, repeated links count once.
    """
    links = links.where("u is not null and v is not null and u <> v").select("u", "v")
    live = staged(links.union(links.select("v", "u")).distinct(), "links")
    names = None
    while live.limit(1).count():
        best = F.min(F.struct(F.xxhash64("v").alias("rank"), F.col("v").alias("name")))
        picked = staged(
            live.groupBy("u").agg(best.alias("best")).select(
                F.col("u").alias("node"),
                F.when(F.col("best.rank") < F.xxhash64("u"), F.col("best.name")).otherwise(F.col("u")).alias("name"),
            ),
            "picked",
        )
        if names is None:
            names = picked.withColumnRenamed("node", "id")
        else:
            names = staged(
                names.withColumnRenamed("name", "node").join(picked, "node", "left")
                .select("id", F.coalesce("name", "node").alias("name")),
                "names",
            )
        left = picked.select(F.col("node").alias("u"), F.col("name").alias("new_u"))
        right = picked.select(F.col("node").alias("v"), F.col("name").alias("new_v"))
        live = staged(
            live.join(left, "u").join(right, "v").where("new_u <> new_v")
            .select(F.col("new_u").alias("u"), F.col("new_v").alias("v")).distinct(),
            "links",
        )
    if names is None:
        return live.select(F.col("u").alias("id"), F.col("v").alias("component"))
    smallest = staged(names.groupBy("name").agg(F.min("id").alias("component")), "smallest")
    return staged(names.join(smallest, "name").select("id", "component"), "components")
