"""Declared reads: files with a fixed schema, or JDBC split into ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.sources.catalog import BATCH, SOURCE_TABLES, TableSpec


def table_spec(table: str | TableSpec) -> TableSpec:
    if isinstance(table, TableSpec):
        return table
    if table not in SOURCE_TABLES:
        raise KeyError(f"unknown source table {table!r}; declared: {sorted(SOURCE_TABLES)}")
    return SOURCE_TABLES[table]


def apply_select_list(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns only, cast to the declared types, plus the columns derived at ingest."""
    typed = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    for name, expression in spec.derived.items():
        typed = typed.withColumn(name, F.expr(expression))
    return typed.drop(*spec.drop)


def read_source(spark: SparkSession, table: str | TableSpec, path: str, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """A landed source table with its declared schema - no inference."""
    spec = table_spec(table)
    reader = spark.read.schema(spec.schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
    return apply_select_list(reader.format(fmt).load(path), spec)


def read_jdbc(spark: SparkSession, table: str | TableSpec, options: dict[str, str], dbtable: str,
              predicates: Sequence[str] | None = None) -> DataFrame:
    """A live table over JDBC; each predicate becomes one parallel partition of the read.

    A batch table needs predicates (``range_predicates``), or one connection would read all of it. Times arrive without a
    zone, as they are declared, so bounds on them reach the source.
    """
    spec = table_spec(table)
    if spec.strategy == BATCH and not predicates:
        raise ValueError(f"{spec.name}: a batch table is read in ranges, give predicates")
    options = {"preferTimestampNTZ": "true", **options}
    if predicates:
        properties = {k: v for k, v in options.items() if k != "url"}
        raw = spark.read.jdbc(options["url"], dbtable, predicates=list(predicates), properties=properties)
    else:
        raw = spark.read.format("jdbc").options(**options).option("dbtable", dbtable).load()
    return apply_select_list(raw, spec)


def range_predicates(col: str, bounds: Sequence[tuple[str, str]]) -> list[str]:
    """SQL conditions ``lo <= col < hi`` for a JDBC read."""
    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    return [f"{col} >= {quoted(lo)} AND {col} < {quoted(hi)}" for lo, hi in bounds]


def read_partitioned(df: DataFrame, col: str, bounds: Sequence[tuple], batch_prefix: str = "range") -> DataFrame:
    """Rows of the given half-open ranges with the number of their range, in one scan.

    Ranges must not overlap; their count is the number of configured batches, a small list.
    """
    number = F.lit(None).cast("string")
    for i, (lo, hi) in enumerate(bounds, start=1):
        number = F.when((F.col(col) >= lo) & (F.col(col) < hi), F.lit(f"{batch_prefix}_{i}")).otherwise(number)
    lowest, highest = min(lo for lo, _ in bounds), max(hi for _, hi in bounds)
    return (
        df.where((F.col(col) >= lowest) & (F.col(col) < highest))
        .withColumn("_batch_id", number).where(F.col("_batch_id").isNotNull())
    )
