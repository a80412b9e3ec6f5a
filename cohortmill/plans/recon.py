"""Source-to-target reconciliation, freshness, and proofs that details and summary agree."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateLike, as_date
from cohortmill.operators.filters import within
from cohortmill.sources.catalog import TableSpec

STALE_HOURS = 26.0
TOLERANCE_PCT = 0.01

# Report category -> tables, in display order. Tables not listed come last.
TABLE_CATEGORIES = {
    "People and organisation": (
        "hr_employee", "emp_node_role", "emp_org_info", "emp_user_group", "user_group", "process_role_user",
    ),
    "Master data": ("mdm_line_desc", "mdm_prod_area", "mdm_factory_area", "mdm_mfg_site", "mdm_mfg_plant"),
    "Function settings": ("function_config", "function_client_mapping"),
    "Workflow engine": ("procdef", "taskinst", "varinst", "procinst", "identitylink"),
    "Daily user summary": ("kpi_user_config_log",),
}
OTHER_CATEGORY = "Other"


def key_comparison(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on each side, from one aggregation over both sides.

    Grouping treats NULL keys as equal and combines before the shuffle, so neither NULLs nor hot keys hurt - a
    join or a NOT IN would be slower and, with NULLs, wrong.
    """
    sides = (
        source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t"))
        .unionByName(target.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    )
    return sides.groupBy(*keys).agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"))


def reconcile_counts(source: DataFrame, target: DataFrame, keys: Sequence[str], table: str,
                     unique_in_source: bool = True) -> DataFrame:
    """One row for a table: rows and distinct keys on both sides, missing count and percent (4 digits).

    Where the key is not unique in the source, its distinct keys are the basis instead of its rows.
    """
    counts = key_comparison(source, target, keys).agg(
        F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
        F.count_if(F.col("source_rows") > 0).alias("source_keys"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"),
        F.count_if(F.col("target_rows") > 0).alias("target_keys"),
        F.count_if((F.col("source_rows") > 0) & (F.col("target_rows") == 0)).alias("keys_not_in_target"),
    )
    basis = F.col("source_rows") if unique_in_source else F.col("source_keys")
    return counts.select(
        F.lit(table).alias("table"), F.lit(unique_in_source).alias("unique_in_source"),
        "source_rows", "source_keys", "target_rows", "target_keys", "keys_not_in_target",
        basis.alias("basis_rows"),
        (basis - F.col("target_keys")).alias("missing"),
        F.round(F.col("target_keys") * F.lit(100.0) / F.nullif(basis, F.lit(0)), 4).alias("pct"),
    )


def frozen_window(df: DataFrame, time_col: str, cutoff, days: int = 2, history_start=None) -> DataFrame:
    """Rows in ``[max(cutoff - days, history_start), cutoff)``; use the same bounds on both sides."""
    upper = cutoff.scalar() if isinstance(cutoff, DataFrame) else F.lit(cutoff).cast("timestamp_ntz")
    lower = upper - F.expr(f"INTERVAL '{int(days)}' DAY")
    if history_start is not None:
        lower = F.greatest(lower, F.lit(history_start).cast("timestamp_ntz"))
    return df.where(within(time_col, lower, upper))


def classify_gap(counts: DataFrame, tolerance_pct: float = TOLERANCE_PCT,
                 stale: Column | None = None, key_available: Column | None = None) -> DataFrame:
    """Add the verdict of a ``reconcile_counts`` row.

    A stale table is STALE whatever its counts say. Then: nothing in the source; equal rows; no key to compare;
    compared by distinct keys where the source key is not unique; a difference within tolerance; a gap.
    """
    stale = F.lit(False) if stale is None else stale
    key_available = F.lit(True) if key_available is None else key_available
    target, basis = F.col("target_keys"), F.col("basis_rows")
    off_pct = F.abs(target - basis) * F.lit(100.0) / F.nullif(basis, F.lit(0))
    verdict = (
        F.when(stale, F.lit("STALE"))
        .when(F.col("source_rows") == 0, F.lit("NO_SOURCE_DATA"))
        .when(target == F.col("source_rows"), F.lit("OK"))
        .when(~key_available, F.lit("SKIP_NO_KEY"))
        .when(target == basis, F.when(F.col("unique_in_source"), F.lit("OK")).otherwise(F.lit("OK_KEY_COLLAPSE")))
        .when(off_pct <= tolerance_pct, F.lit("OK_BOUNDARY"))
        .otherwise(F.lit("GAP"))
    )
    return counts.withColumn("verdict", verdict)


def freshness_lag(source: DataFrame, target: DataFrame, time_col: str, stale_hours: float = STALE_HOURS) -> DataFrame:
    """Newest time on both sides, the lag in seconds and whether it is over the limit."""
    both = (
        source.select(F.col(time_col).alias("_s"), F.lit(None).cast(source.schema[time_col].dataType).alias("_t"))
        .unionAll(target.select(F.lit(None).cast(target.schema[time_col].dataType), F.col(time_col)))
    )
    lag = F.timestamp_diff("SECOND", F.col("target_max"), F.col("source_max"))
    return both.agg(F.max("_s").alias("source_max"), F.max("_t").alias("target_max")).withColumns({
        "lag_seconds": lag,
        "stale": F.coalesce(lag > F.lit(stale_hours * 3600), F.lit(False)),
    })


def audit_table(spec: TableSpec, source: DataFrame, target: DataFrame, cutoff=None, days: int = 2,
                tolerance_pct: float = TOLERANCE_PCT, stale_hours: float = STALE_HOURS) -> DataFrame:
    """The verdict row of one declared table.

    Batch tables are compared inside the frozen window before ``cutoff`` and checked for lag over all rows; full
    tables are compared whole. A key column the source does not deliver makes the table SKIP_NO_KEY.
    """
    stale, lag_seconds = F.lit(False), F.lit(None).cast("bigint")
    if spec.time_col:
        lag = freshness_lag(source, target, spec.time_col, stale_hours)
        stale, lag_seconds = lag.select("stale").scalar(), lag.select("lag_seconds").scalar()
        source, target = (frozen_window(side, spec.time_col, cutoff, days, spec.history_start) for side in (source, target))
    available = set(spec.keys) <= set(source.columns)
    if available:
        counts = reconcile_counts(source, target, spec.keys, spec.name, spec.unique_in_source)
    else:
        per_key = target.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))
        sides = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("target_rows"), F.count(F.lit(1)).alias("target_keys"))
        rows = source.agg(F.count(F.lit(1)).alias("source_rows"))
        counts = sides.withColumn("source_rows", rows.scalar()).select(
            F.lit(spec.name).alias("table"), F.lit(spec.unique_in_source).alias("unique_in_source"),
            "source_rows", F.lit(None).cast("bigint").alias("source_keys"), "target_rows", "target_keys",
            F.lit(None).cast("bigint").alias("keys_not_in_target"), F.col("source_rows").alias("basis_rows"),
            (F.col("source_rows") - F.col("target_keys")).alias("missing"), F.lit(0.0).alias("pct"),
        )
    verdicts = classify_gap(counts, tolerance_pct, stale, F.lit(available))
    return verdicts.withColumn("lag_seconds", lag_seconds)


def audit_catalog(pairs: Mapping[str, tuple[DataFrame, DataFrame]], specs: Mapping[str, TableSpec], cutoff=None,
                  days: int = 2) -> DataFrame:
    """The verdict rows of many declared tables, name -> (source, target), and whether their key sets differ.

    ``keys_differ`` also shows what equal counts hide: one key missing and another too many.
    """
    rows = None
    for name, (source, target) in pairs.items():
        row = audit_table(specs[name], source, target, cutoff, days)
        rows = row if rows is None else rows.unionByName(row)
    missing, extra = F.col("keys_not_in_target"), F.col("target_keys") - F.col("source_keys") + F.col("keys_not_in_target")
    return rows.withColumn("keys_differ", F.coalesce((missing > 0) | (extra > 0), F.lit(False)))


def catalog_gaps(verdicts: DataFrame, pairs: Mapping[str, tuple[DataFrame, DataFrame]], specs: Mapping[str, TableSpec],
                 cutoff=None, days: int = 2) -> dict[str, DataFrame]:
    """The missing keys of those tables of an audit whose keys differ; only their names, one per table, are collected."""
    gaps = {}
    for row in verdicts.where("keys_not_in_target > 0").select("table").collect():
        spec = specs[row["table"]]
        source, target = pairs[spec.name]
        if spec.time_col:
            source, target = (frozen_window(x, spec.time_col, cutoff, days, spec.history_start) for x in (source, target))
        gaps[spec.name] = missing_keys(source, target, spec.keys, spec.time_col)
    return gaps


def missing_keys(source: DataFrame, target: DataFrame, keys: Sequence[str], time_col: str | None = None,
                 n: int | None = None) -> DataFrame:
    """Source keys absent in the target with first seen time and row count; all of them, or the first ``n`` for a report."""
    seen = F.col(time_col) if time_col else F.lit(None).cast("timestamp_ntz")
    seen_type = source.schema[time_col].dataType if time_col else "timestamp_ntz"
    sides = source.select(*keys, seen.alias("_seen"), F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*keys, F.lit(None).cast(seen_type).alias("_seen"), F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    absent = (
        sides.groupBy(*keys)
        .agg(F.min("_seen").alias("first_seen"), F.sum("_s").alias("src_rows"), F.max("_t").alias("_known"))
        .where("_known = 0").drop("_known")
    )
    return absent if n is None else absent.orderBy(*keys).limit(n)


def percent_of_target(pct: Column, missing: Column) -> Column:
    """'100.00%' only when nothing is missing; otherwise four digits and at most 99.9999 while any is."""
    def four(p: Column) -> Column:
        return F.concat(F.call_function("format_number", p, F.lit("0.0000")), F.lit("%"))

    return (
        F.when(missing == 0, F.lit("100.00%"))
        .when(missing > 0, four(F.least(pct, F.lit(99.9999))))
        .otherwise(four(pct))
    )


def _category_columns() -> tuple[Column, Column]:
    category, order = F.lit(OTHER_CATEGORY), F.lit(len(TABLE_CATEGORIES) + 1) * 1000
    for i, (name, tables) in enumerate(TABLE_CATEGORIES.items(), start=1):
        for j, table in enumerate(tables):
            hit = F.col("table") == table
            category = F.when(hit, F.lit(name)).otherwise(category)
            order = F.when(hit, F.lit(i * 1000 + j)).otherwise(order)
    return category, order


def reconciliation_report(verdicts: DataFrame) -> DataFrame:
    """Report rows in category order, then the grand total."""
    category, order = _category_columns()
    rows = verdicts.select(
        order.cast("int").alias("ord"), category.alias("category"), "table",
        F.col("basis_rows").alias("source_rows"), F.col("target_keys").alias("target_rows"), "missing",
        F.when(F.col("basis_rows") == 0, F.lit(100.0))
        .otherwise(F.col("target_keys") * F.lit(100.0) / F.nullif(F.col("basis_rows"), F.lit(0))).alias("pct_value"),
        "verdict",
    )
    total = rows.agg(
        F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"),
        F.sum("missing").alias("missing"), F.count(F.lit(1)).alias("_tables"),
    ).select(
        F.lit(1_000_000).alias("ord"), F.lit("Total").alias("category"),
        F.concat(F.col("_tables").cast("string"), F.lit(" tables")).alias("table"),
        "source_rows", "target_rows", "missing",
        F.when(F.col("source_rows") == 0, F.lit(100.0))
        .otherwise(F.col("target_rows") * F.lit(100.0) / F.nullif(F.col("source_rows"), F.lit(0))).alias("pct_value"),
        F.lit("").alias("verdict"),
    )
    return (
        rows.unionByName(total)
        .withColumn("pct", percent_of_target(F.col("pct_value"), F.col("missing")))
        .drop("pct_value").orderBy("ord", "table")
    )


def write_report_csv(report: DataFrame, path: str) -> None:
    """The report has one row per table, so one file is fine."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def detail_day_counts(detail: DataFrame, cohort: bool, day: DateLike | None = None) -> DataFrame:
    """Day counters rebuilt from exported detail rows.

    ``cohort``: opening days of the opening month's file. Otherwise every event day, counted in the file of
    that day's month.
    """
    start, claim, end = F.col("task_start_date"), F.col("task_claim_date"), F.col("task_end_date")
    if cohort:
        rows = detail.where(F.col("in_month_cohort") == 1).withColumn("day", start)
    else:
        rows = detail.withColumn("day", F.explode(F.array_distinct(F.array(start, claim, end)))).where(
            F.date_format("day", "yyyy-MM") == F.col("file_month")
        )
    if day is not None:
        rows = rows.where(F.col("day") == as_date(day))
    d = F.col("day")
    ended = F.coalesce(end == d, F.lit(False))
    claimed = F.coalesce(claim == d, F.lit(False))
    return rows.groupBy("day", "vx_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if((start == d) & ~claimed & ~ended).alias("todo"),
        F.count_if(claimed & ~ended).alias("doing"),
        F.count_if(ended).alias("done"),
    )


def detail_month_counts(detail: DataFrame) -> DataFrame:
    """Month counters from the status label of the opening month's rows."""
    status = F.col("status_monthly")
    return detail.where(F.col("in_month_cohort") == 1).groupBy("file_month", "vx_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "TODO").alias("todo"),
        F.count_if(status == "DOING").alias("doing"),
        F.count_if(status == "DONE").alias("done"),
    )


def summary_counts(summary: DataFrame, grain: str, period: str | None = None) -> DataFrame:
    """The summary's counters per period and vx_type, to put next to the rebuilt ones."""
    rows = summary.where(F.col("period_type") == grain)
    if period is not None:
        rows = rows.where(F.col("period_key") == period)
    return rows.groupBy("period_key", "vx_type").agg(
        F.sum("total_qty").alias("total"), F.sum("todo_qty").alias("todo"),
        F.sum("doing_qty").alias("doing"), F.sum("done_qty").alias("done"),
    )


def proof_differences(rebuilt: DataFrame, summarised: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Periods whose counters differ between details and summary (a missing side counts as zero)."""
    values = ("total", "todo", "doing", "done")
    signed = rebuilt.select(*keys, *values).unionByName(
        summarised.select(*keys, *[(-F.col(v)).alias(v) for v in values])
    )
    sums = signed.groupBy(*keys).agg(*[F.sum(v).alias(f"{v}_diff") for v in values])
    differs = F.greatest(*[F.col(f"{v}_diff") != 0 for v in values])
    return sums.where(differs)


def conservation_violations(summary: DataFrame) -> DataFrame:
    """Cohort rows where todo + doing + done is not the total. Event-day rows are not cohorts: leave them out."""
    return summary.where(F.col("todo_qty") + F.col("doing_qty") + F.col("done_qty") != F.col("total_qty"))


def boundary_profile(summary: DataFrame, cutoff: dt.date | str) -> DataFrame:
    """Date span and row count on both sides of the cutoff, per grain."""
    regime = F.when(F.col("snapshot_date") < as_date(cutoff), F.lit("historical")).otherwise(F.lit("current"))
    return summary.groupBy(regime.alias("regime"), "period_type").agg(
        F.min("snapshot_date").alias("min_date"), F.max("snapshot_date").alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionByName(part)
    return whole

