"""Parquet tables that survive lost executors and failed runs.

A snapshot table is a folder of versions plus a small append-only log; a version counts once its log row is
committed, so a failed load leaves the old version in place. Period tables are overwritten partition by partition.
One writer per table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.session import scratch_path

LOG = "_versions_log"


class EmptySnapshotError(ValueError):
    """A full load returned no rows; the previous snapshot stays."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is there: a missing folder or one without data files is not; any other error is raised."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    return spark.read.parquet(f"{root}/{LOG}") if path_exists(spark, f"{root}/{LOG}") else None


def current_version(spark: SparkSession, root: str) -> str | None:
    log = _log(spark, root)
    if log is None:
        return None
    newest = log.agg(F.max_by("version", "sequence").alias("version")).first()
    return newest["version"]


def replace_snapshot(df: DataFrame, root: str, allow_empty: bool = False, keep: int | None = None) -> int:
    """Stage a full load, reject it when empty, then make it current; returns its rows.

    With ``keep``, versions older than the newest ``keep`` are emptied; keep at least 2 where readers may still be at
    work on the version before.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    staged = f"{root}/version={version}"
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged).count()
    if rows == 0 and not allow_empty:
        raise EmptySnapshotError(f"{root}: the load returned no rows, keeping the previous snapshot")
    log = _log(spark, root)
    sequence = 1 if log is None else log.count() + 1
    entry = spark.createDataFrame([(sequence, version, rows)], "sequence bigint, version string, row_count bigint")
    entry.coalesce(1).write.mode("append").parquet(f"{root}/{LOG}")
    if keep is not None and sequence > keep:
        expire_versions(spark, root, keep)
    return rows


def expire_versions(spark: SparkSession, root: str, keep: int) -> int:
    """Empty all but the newest ``keep`` committed versions; returns how many were emptied.

    What was emptied is noted in the log (sequence 0), so each version is emptied once.
    """
    if keep < 1:
        raise ValueError("the current version stays: keep must be at least 1")
    held = _log(spark, root).groupBy("version").agg(F.max("sequence").alias("sequence"), F.min("sequence").alias("first"))
    old = [row["version"] for row in held.where("first > 0").orderBy(F.desc("sequence")).collect()[keep:]]
    for version in old:
        release(spark, f"{root}/version={version}")
    if old:
        gone = spark.createDataFrame([(0, v, None) for v in old], "sequence bigint, version string, row_count bigint")
        gone.coalesce(1).write.mode("append").parquet(f"{root}/{LOG}")
    return len(old)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root}: no committed snapshot")
    return spark.read.parquet(f"{root}/version={version}")


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_periods(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions ``df`` holds; running the same window twice gives the same table.

    ``df`` must not read ``path`` itself - put it in ``stages`` first if it does. Rebalancing on the partition
    columns gives each partition few files and lets AQE split a partition that is too large for one task.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def remove_partitions(partitions: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Empty the partition folders listed in ``partitions`` - a short list, one row per calendar period.

    Each folder is overwritten with no rows; folders that are not there stay so. Returns how many were emptied.
    """
    spark = partitions.sparkSession
    columns = spark.read.parquet(path).drop(*partition_by)
    emptied = 0
    for row in partitions.select(*partition_by).distinct().toLocalIterator():
        folder = "/".join([path.rstrip("/"), *[f"{c}={row[c]}" for c in partition_by]])
        if path_exists(spark, folder):
            columns.limit(0).coalesce(1).write.mode("overwrite").parquet(folder)
            emptied += 1
    return emptied


def release(spark: SparkSession, path: str) -> None:
    """Give back the space of a folder and all below it: an empty table takes its place."""
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


@contextmanager
def stages(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Cut lineage within a block: ``stage(df)`` writes to the shared scratch space and reads back.

    Columnar and compressed, with its size known to the planner; survives lost executors like any table. The space is
    given back when the block ends, so results that outlive it must be written elsewhere in the block.
    """
    root, used = scratch_path(spark, "stages"), []

    def stage(df: DataFrame) -> DataFrame:
        path = f"{root}/{len(used)}"
        used.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        if used:
            release(spark, root)
