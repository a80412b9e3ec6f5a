"""Continuous ingest of task changes: the same tables, fed by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cohortmill.operators.versions import latest_by_key
from cohortmill.plans.daily import apply_changes
from cohortmill.sources.tables import append_rows


def change_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """New files of a landing folder as a stream; Spark streaming needs the schema up front."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def deduplicated(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first delivery of each key, however late it is: no watermark, so no change is dropped for its age.

    The state holds every key seen. Where that is too much, leave repeats to ``append_with_batch``, which keeps one row
    per key and batch, and to ``latest_by_key`` on reading.
    """
    return changes.dropDuplicates(list(keys))


def run_available(changes: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None],
                  timeout: int | None = None) -> StreamingQuery:
    """Process everything that has arrived, then stop; the checkpoint makes the next run continue."""
    query = (
        changes.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(timeout)
    return query


def append_with_batch(path: str, keys: Sequence[str], version_cols: Sequence[str],
                      partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends each key's newest change to the bronze log.

    A batch replayed after a failure appends its rows again; they are equal versions of the same keys, which
    ``latest_by_key`` resolves when the log is read.
    """
    def write(batch: DataFrame, _batch_id: int) -> None:
        append_rows(latest_by_key(batch, keys, version_cols), path, partition_by)

    return write


def refresh_with_batch(fact_path: str, summary_path: str, cutoff, as_of,
                       version_cols: Sequence[str] = ("_mview_update_time",)) -> Callable[[DataFrame, int], None]:
    """A batch writer that puts changed task rows into the fact and recomputes the summary months they reach.

    Replaying a batch replaces the same rows and recomputes the same partitions, so it changes nothing; after a failure
    between fact and summary the replay also recomputes the partitions the failed run had reached.
    """
    def write(batch: DataFrame, _batch_id: int) -> None:
        newest = latest_by_key(batch, ["task_id"], version_cols)
        if not newest.isEmpty():
            apply_changes(batch.sparkSession, newest, fact_path, summary_path, cutoff, as_of, version_cols)

    return write
