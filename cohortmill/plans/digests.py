"""Reconciliation by digests: both sides are summed up per hash range, and only ranges that differ are compared key by key.

A digest of a range is the number of its rows and the sum and exclusive or of their key hashes; it does not depend on the
order of rows, and it is combined before the shuffle, so a comparison of equal tables moves one row per range and input
partition, whatever their size. Where a differing range still holds many rows, the next bits of the hash cut it again, in
a scan of that range alone. Keys are shuffled for ranges that differ at the last level, and their comparison is exact.

Two different multisets of keys share all three figures of a range with a probability of about 2 ** -64; then the range
counts as equal. NULL keys are equal to each other. Sides may have the key in different types; values are compared as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.plans.recon import key_comparison, missing_keys
from cohortmill.session import scratch_path

# Bits of the hash per level, and the rows of both sides that a range may hold before it is cut again.
RANGE_BITS = 12
RANGE_ROWS = 1_000_000
_LEVELS = 4


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key; the position of NULLs counts."""
    return F.xxhash64(*[part for k in keys for part in (F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit("")))])


def range_of(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits)


def range_digests(df: DataFrame, keys: Sequence[str], bits: int = RANGE_BITS) -> DataFrame:
    """(range, rows, total, mixed) of a table: one row per hash range that has any row."""
    hashed = df.select(key_hash(keys).alias("_hash"))
    return hashed.groupBy(range_of(F.col("_hash"), bits).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("total"), F.bit_xor("_hash").alias("mixed"))


def differing(source: DataFrame, target: DataFrame) -> DataFrame:
    """(range, rows of both sides) of the ranges whose digests are not the same."""
    sides = source.withColumn("_sign", F.lit(1)).unionByName(target.withColumn("_sign", F.lit(-1)))
    both = sides.groupBy("range").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("_sign")).alias("_rows"),
        F.sum(F.col("total") * F.col("_sign")).alias("_total"), F.bit_xor("mixed").alias("_mixed"))
    return both.where("_rows <> 0 or _total <> 0 or _mixed <> 0").select("range", "rows")


def in_ranges(df: DataFrame, keys: Sequence[str], ranges: DataFrame, bits: int) -> DataFrame:
    """Rows whose key lies in one of the ranges, a short list that Spark broadcasts by its size."""
    marked = df.withColumn("_range", range_of(key_hash(keys), bits))
    return marked.join(ranges.select(F.col("range").alias("_range")), "_range", "left_semi").drop("_range")


def narrowed(source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = RANGE_BITS,
             rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Both sides without the ranges that agree, and figures: rows of both sides, levels, ranges and rows left.

    A key is in one range, so what is left holds all rows of each key that is on one side alone.
    """
    spark, left, right, level = source.sparkSession, source, target, 0
    totals = [0, 0]
    while True:
        level += 1
        depth = bits * level
        path = scratch_path(spark, f"digests-{level}")
        sides = [range_digests(side, keys, depth) for side in (left, right)]
        if level == 1:
            sides = [_kept(side, f"{path}-{n}") for n, side in enumerate(sides)]
            totals = [side.agg(F.sum("rows")).first()[0] or 0 for side in sides]
        ranges = _kept(differing(*sides), path)
        found = ranges.agg(F.count(F.lit(1)).alias("ranges"), F.sum("rows").alias("rows"), F.max("rows").alias("most")).first()
        left, right = (in_ranges(side, keys, ranges, depth) for side in (source, target))
        if not found["ranges"] or found["most"] <= rows or level == _LEVELS:
            break
    return left, right, {"source_rows": totals[0], "target_rows": totals[1], "levels": level, "ranges": found["ranges"],
                         "compared_rows": found["rows"] or 0}


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def missing_by_digest(source: DataFrame, target: DataFrame, keys: Sequence[str], time_col: str | None = None,
                      n: int | None = None, **cut: int) -> DataFrame:
    """``recon.missing_keys`` over the ranges that differ: the same rows, without a shuffle of the keys that agree."""
    left, right, _ = narrowed(source, target, keys, **cut)
    return missing_keys(left, right, keys, time_col, n)


def reconcile_by_digest(source: DataFrame, target: DataFrame, keys: Sequence[str], table: str, **cut: int) -> DataFrame:
    """One row for a table: rows of both sides, keys on one side alone, and how much had to be compared key by key."""
    left, right, figures = narrowed(source, target, keys, **cut)
    counts = key_comparison(left, right, keys).agg(
        F.count_if((F.col("source_rows") > 0) & (F.col("target_rows") == 0)).alias("keys_not_in_target"),
        F.count_if((F.col("target_rows") > 0) & (F.col("source_rows") == 0)).alias("keys_not_in_source"))
    return counts.select(F.lit(table).alias("table"), *[
        F.lit(figures[c]).cast("bigint").alias(c) for c in ("source_rows", "target_rows")], "keys_not_in_target", "keys_not_in_source",
        *[F.lit(figures[c]).cast("bigint").alias(c) for c in ("levels", "ranges", "compared_rows")])
