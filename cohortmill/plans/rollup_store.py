"""Stored rollups of the summary: sums over fewer levels, kept per period, and chosen by what a request needs.

All rollups of a lattice come from one aggregation and lie in one table, in folders of rollup and month (all grains of a month
share one: they are small). A change of the summary renews the folders of its own months only. Counts of the summary add up over levels, so a report read from
a rollup equals the one from the summary as long as no level it filters or groups by was rolled away; a measure that
takes the newest row per level combination first (``monthly_report``) needs all levels, hence the summary itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill import DIMENSIONS
from cohortmill.operators.filters import filters_of
from cohortmill.operators.summary import SUMMARY_COLUMNS
from cohortmill.sources.tables import (
    append_rows, current_version, overwrite_periods, path_exists, read_snapshot, remove_partitions, replace_snapshot, stages,
)

Lattice = Mapping[str, Sequence[str]]

# Levels each rollup keeps. All five levels are the summary itself, which needs no copy.
LATTICE: Lattice = {
    "total": (),
    "by_vx": ("vx_type",),
    "by_plant": ("region", "plant"),
    "by_vx_plant": ("vx_type", "region", "plant"),
    "by_vx_factory": ("vx_type", "region", "plant", "factory"),
}
FOLDERS = ("rollup", "period_month")
_KEYS = ("period_month", "period_type", "period_key", "sort_order", "period_name")
_COUNTS = tuple(c for c in SUMMARY_COLUMNS if c.endswith("_qty"))
LATTICE_DDL = "rollup string, levels array<string>"
SIZES_DDL = "sequence bigint, rollup string, period_month string, row_count bigint"


def rollup_path(summary_path: str) -> str:
    return summary_path.rstrip("/") + "_rollups"


def sizes_path(root: str) -> str:
    return root.rstrip("/") + "_sizes"


def lattice_path(root: str) -> str:
    return root.rstrip("/") + "_lattice"


def check_lattice(lattice: Lattice) -> Lattice:
    """Reject levels that do not exist and rollups that keep the same levels."""
    kept = [frozenset(levels) for levels in lattice.values()]
    unknown = set().union(*kept) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"not a dimension: {sorted(unknown)}")
    if len(set(kept)) < len(kept):
        raise ValueError("two rollups keep the same levels")
    return lattice


def rollup_rows(summary: DataFrame, lattice: Lattice = LATTICE) -> DataFrame:
    """All rollups of summary rows with ``period_month``, in one pass: ``rollup``, the period, the levels, the counts.

    Levels that were rolled away are NULL; ``rollup`` tells them from levels that are NULL. ``snapshot_date`` is the newest
    of the rows added up. Rows are combined before the shuffle, so a period of many level combinations sends one row per
    input partition and rollup group.
    """
    check_lattice(lattice)
    sets = [[*_KEYS, *levels] for levels in lattice.values()]
    sums = summary.groupingSets(sets, *_KEYS, *DIMENSIONS).agg(
        F.grouping_id().alias("_gone"), F.max("snapshot_date").alias("snapshot_date"),
        *[F.sum(c).alias(c) for c in _COUNTS],
    )
    name = F.lit(None).cast("string")
    for rollup, levels in lattice.items():
        gone = sum(1 << place for place, level in enumerate(reversed(DIMENSIONS)) if level not in levels)
        name = F.when(F.col("_gone") == gone, rollup).otherwise(name)
    return sums.select(name.alias("rollup"), "period_month", *SUMMARY_COLUMNS)


def store_rollups(summary: DataFrame, root: str, lattice: Lattice = LATTICE) -> None:
    """Write all rollups of a whole summary, in place of those stored; ``refresh_rollups`` keeps them up to date from then on.

    Readers see the new lattice once its rows are complete; while they are written, reports must read the summary.
    """
    spark = summary.sparkSession
    rows = rollup_rows(summary, lattice)
    rows.hint("rebalance", *FOLDERS).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *FOLDERS).parquet(root)
    counts = _folder_counts(spark.read.schema(rows.schema).parquet(root))
    counts.select(F.lit(1).cast("bigint").alias("sequence"), *FOLDERS, "row_count").coalesce(1).write.mode(
        "overwrite").parquet(sizes_path(root))
    levels = spark.createDataFrame([(name, list(kept)) for name, kept in lattice.items()], LATTICE_DDL)
    replace_snapshot(levels.coalesce(1), lattice_path(root), allow_empty=True, keep=2)


def stored_lattice(spark: SparkSession, root: str) -> Lattice:
    """The rollups that are stored and the levels each keeps; empty if there are none."""
    if current_version(spark, lattice_path(root)) is None:
        return {}
    return {row["rollup"]: tuple(row["levels"]) for row in read_snapshot(spark, lattice_path(root)).collect()}


def refresh_rollups(summary: DataFrame, root: str, months: Iterable[str]) -> None:
    """Renew the stored rollups of calendar months ('yyyyMM') from the summary's folders of these months.

    Folders that no longer have any row are emptied. Repeating a call changes nothing, nor does one where none are stored.
    """
    spark, wanted = summary.sparkSession, sorted(set(months))
    lattice = stored_lattice(spark, root)
    if not wanted or not lattice:
        return
    # Literals prune folders when the scan is planned.
    rows = summary.where(F.col("period_month").isin(wanted))
    with stages(spark) as stage:
        renewed = stage(rollup_rows(rows, lattice))
        overwrite_periods(renewed, root, FOLDERS)
        counts = {tuple(row[c] for c in FOLDERS): row["row_count"] for row in _folder_counts(renewed).collect()}
    emptied = [(rollup, month) for rollup in lattice for month in wanted if (rollup, month) not in counts]
    if emptied:
        remove_partitions(spark.createDataFrame(emptied, ", ".join(f"{c} string" for c in FOLDERS)), root, FOLDERS)
    log = sizes_path(root)
    following = (spark.read.schema(SIZES_DDL).parquet(log).agg(F.max("sequence")).first()[0] or 0) + 1
    sizes = [(following, *folder, rows) for folder, rows in [*counts.items(), *((folder, 0) for folder in emptied)]]
    append_rows(spark.createDataFrame(sizes, SIZES_DDL).coalesce(1), log)


def _folder_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*FOLDERS).agg(F.count(F.lit(1)).alias("row_count"))


def read_rollups(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).withColumn("period_month", F.col("period_month").cast("string"))


def rollup_sizes(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows of each rollup, from the log of sizes; the rows themselves are not read."""
    log = spark.read.schema(SIZES_DDL).parquet(sizes_path(root))
    newest = log.groupBy(*FOLDERS).agg(F.max_by("row_count", "sequence").alias("row_count"))
    return {r["rollup"]: r["rows"] for r in newest.groupBy("rollup").agg(F.sum("row_count").alias("rows")).collect()}


def smallest_covering(sizes: Mapping[str, int], needed: Iterable[str], lattice: Lattice) -> str | None:
    """The rollup with the fewest rows that keeps all ``needed`` levels; None if only the summary does."""
    wanted = set(needed)
    fitting = [(sizes.get(name, 0), name) for name, levels in lattice.items() if wanted <= set(levels)]
    return min(fitting)[1] if fitting else None


def serve(summary: DataFrame, root: str, by: Sequence[str] = (), **dims) -> DataFrame:
    """Rows in the summary's layout for a report that groups by ``by`` and filters by ``dims``: those of the smallest rollup
    that covers both, or the summary's own.

    Pass the result where the summary would go: ``periodic_report(serve(...), anchor, **dims)``. Columns of ``by`` that are not
    levels (grain, period) are in every rollup.
    """
    spark = summary.sparkSession
    needed = {*(c for c in by if c in DIMENSIONS), *filters_of(**dims)}
    lattice = stored_lattice(spark, root)
    chosen = smallest_covering(rollup_sizes(spark, root), needed, lattice) if lattice else None
    if chosen is None or not path_exists(spark, root):
        return summary
    return read_rollups(spark, root).where(F.col("rollup") == chosen).select(*SUMMARY_COLUMNS, "period_month")
