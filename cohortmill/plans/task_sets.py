"""The stored dictionary of task ids and the stored daily sets, kept up to date run by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions.dates import year_month
from cohortmill.operators.task_sets import unnumbered, number_ids, opened_sets
from cohortmill.sources.tables import append_rows, overwrite_periods, path_exists, remove_partitions, stages

DICTIONARY_DDL = "task_id string, id bigint"
MONTH = "start_month"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(DICTIONARY_DDL).parquet(path) if path_exists(spark, path) else None


def extend_dictionary(tasks: DataFrame, path: str) -> int:
    """Give tasks that have no number yet the next free ones; returns how many. Numbers never change.

    One writer. The rows of a run are committed together, so a run that breaks off has given no number; a repeated run finds
    nothing new. Finding new ids reads the id column of the dictionary, in one shuffle.
    """
    spark = tasks.sparkSession
    held = read_dictionary(spark, path)
    highest = None if held is None else held.agg(F.max("id")).first()[0]
    with stages(spark) as stage:
        new = stage(number_ids(unnumbered(held, tasks), 0 if highest is None else highest + 1, stage))
        count = new.count()
        if count:
            append_rows(new, path)
    return count


def write_sets(fact: DataFrame, dictionary: DataFrame, path: str) -> None:
    """Store the daily sets of the opening months ``fact`` holds, replacing those months; run it with whole months."""
    sets = opened_sets(fact, dictionary).withColumn(MONTH, year_month("snapshot_date"))
    overwrite_periods(sets, path, [MONTH])


def refresh_sets(fact: DataFrame, dictionary: DataFrame, path: str, months: list[str]) -> None:
    """Renew the daily sets of the opening months given, a short list, from a fact stored by month; empty months are emptied."""
    spark, wanted = fact.sparkSession, sorted(set(months))
    rows = fact.where(F.col(MONTH).isin(wanted))
    write_sets(rows.drop(MONTH), dictionary, path)
    held = rows.where((F.col("is_excluded") == 0) & F.col("task_start_date").isNotNull())
    filled = {row[0] for row in held.select(MONTH).distinct().collect()}
    emptied = [(month,) for month in wanted if month not in filled]
    if emptied and path_exists(spark, path):
        remove_partitions(spark.createDataFrame(emptied, f"{MONTH} string"), path, [MONTH])


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH)
