"""Detail exports as gzipped CSV, one file set per month, region, plant and class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.operators.facts import FACT_COLUMNS
from cohortmill.operators.filters import filter_dims, touching_month
from cohortmill.plans.reports import file_months, settled_now

# Columns a reader of the export would mistake for something else.
HIDDEN_COLUMNS = ("task_primary_date", "task_create_date", "ui_time_field", "_mview_update_time", "task_status")
EXPORT_COLUMNS = (*[c for c in FACT_COLUMNS if c not in HIDDEN_COLUMNS], "in_month_cohort", "file_month")
FILE_KEYS = ("file_month", "region", "plant", "vx_type")


def _export_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in EXPORT_COLUMNS if c in df.columns])


def monthly_detail(fact: DataFrame, cutoff: str) -> DataFrame:
    """All counted tasks in all month files they belong to."""
    return _export_columns(file_months(fact, cutoff))


def month_detail(fact: DataFrame, month: str, cutoff: str, **dims) -> DataFrame:
    """One month's rows for the chosen levels, with the cohort flag."""
    counted = fact.where(F.col("is_excluded") == 0)
    rows = settled_now(touching_month(filter_dims(counted, **dims), month, cutoff))
    first = F.lit(f"{month}-01").cast("date")
    opened_here = (F.col("task_start_date") >= first) & (F.col("task_start_date") < F.add_months(first, 1))
    return _export_columns(
        rows.withColumn("in_month_cohort", opened_here.cast("int")).withColumn("file_month", F.lit(month))
    )


def export_preview(detail: DataFrame) -> DataFrame:
    """Month-end counts per class over the opening cohort: what the summary should show."""
    status = F.col("status_monthly")
    return detail.where(F.col("in_month_cohort") == 1).groupBy("vx_type").agg(
        F.count(F.lit(1)).alias("total_task"),
        F.count_if(status == "TODO").alias("todo"),
        F.count_if(status == "DOING").alias("doing"),
        F.count_if(status == "DONE").alias("done"),
    )


def write_detail(detail: DataFrame, path: str, keys: tuple[str, ...] = FILE_KEYS, rows_per_file: int = 2_000_000) -> None:
    """Write the file sets; blank levels get their own folder.

    Rows are rebalanced on the file keys: small sets share tasks, and AQE splits a plant that holds a third of
    all rows over several tasks and files. Partition columns are repeated so the files themselves stay complete.
    """
    folders = {f"_by_{k}": F.col(k) for k in keys}
    (
        detail.withColumns(folders).hint("rebalance", *folders)
        .write.mode("overwrite").partitionBy(*folders)
        .option("header", True).option("compression", "gzip").option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def export_monthly_detail(fact: DataFrame, path: str, cutoff: str) -> None:
    write_detail(monthly_detail(fact, cutoff), path)


def export_month(fact: DataFrame, path: str, month: str, cutoff: str, dry_run: bool = False, **dims) -> DataFrame:
    """Write one month by class and return the preview; a dry run only returns the preview."""
    detail = month_detail(fact, month, cutoff, **dims)
    if not dry_run:
        write_detail(detail, path, ("vx_type",))
    return export_preview(detail)


def write_csv(df: DataFrame, path: str) -> None:
    """Rows of a drill-down as CSV with a header, one file per partition of the result."""
    df.write.mode("overwrite").option("header", True).csv(path)
