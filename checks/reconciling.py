"""Reconciliation and audit checks: orders against the orders that have lines, and details against the summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortmill.plans import digests, recon, reports
from cohortmill.sources.catalog import BATCH, FULL, TableSpec
from cohortmill.operators.summary import day_summary
from checks import adapter as a
from checks.base import Check
from checks.gold import cells, completed, labelled, whole_summary
from checks.oracle import ctes, month_key

CUT = "2001-06-01"
# Report name of each compared pair, its key, and whether the key is unique in the source.
PAIRS = {
    "taskinst": ("orders", "lineitem", ("o_orderkey",), ("l_orderkey",), True),
    "varinst": ("lineitem", "orders", ("l_orderkey",), ("o_orderkey",), False),
    "hr_employee": ("customer", "orders", ("c_custkey",), ("o_custkey",), True),
    "mdm_line_desc": ("lineitem", "part", ("l_partkey",), ("p_partkey",), False),
    "mdm_mfg_site": ("nation", "customer", ("n_nationkey",), ("c_nationkey",), True),
    "unlisted_table": ("supplier", "lineitem", ("s_suppkey",), ("l_suppkey",), True),
}


def _pair(spark, sf, name):
    source, target, source_keys, target_keys, unique = PAIRS[name]
    right = a.table(spark, sf, target).select(*[F.col(t).alias(s) for s, t in zip(source_keys, target_keys)])
    return a.table(spark, sf, source), right, list(source_keys), unique


def counts(spark, sf):
    out = None
    for name in PAIRS:
        source, target, keys, unique = _pair(spark, sf, name)
        row = recon.reconcile_counts(source, target, keys, name, unique)
        out = row if out is None else out.unionByName(row)
    return out


def _counts_sql() -> str:
    parts = []
    for name, (source, target, source_keys, target_keys, unique) in PAIRS.items():
        s, t = source_keys[0], target_keys[0]
        basis = f"(SELECT count(*) FROM {source})" if unique else f"(SELECT count(DISTINCT {s}) FROM {source})"
        target_keys_sql = f"(SELECT count(DISTINCT {t}) FROM {target})"
        parts.append(f"""
        SELECT '{name}' AS "table", CAST({str(unique).upper()} AS BOOLEAN) AS unique_in_source,
          (SELECT count(*) FROM {source}) AS source_rows, (SELECT count(DISTINCT {s}) FROM {source}) AS source_keys,
          (SELECT count(*) FROM {target}) AS target_rows, {target_keys_sql} AS target_keys,
          (SELECT count(*) FROM (SELECT {s} FROM {source} EXCEPT SELECT {t} FROM {target})) AS keys_not_in_target,
          {basis} AS basis_rows, {basis} - {target_keys_sql} AS missing,
          round({target_keys_sql} * 100.0 / NULLIF({basis}, 0), 4) AS pct""")
    return "\nUNION ALL\n".join(parts)


def by_digest(spark, sf):
    """All pairs reconciled by digests, without the figures of the method."""
    out = None
    for name in PAIRS:
        source, target, keys, _ = _pair(spark, sf, name)
        row = digests.reconcile_by_digest(source, target, keys, name).drop("levels", "ranges", "compared_rows")
        out = row if out is None else out.unionByName(row)
    return out


def missing_by_digest(spark, sf):
    """Missing keys of all pairs, found by digests."""
    out = None
    for name in PAIRS:
        source, target, keys, _ = _pair(spark, sf, name)
        rows = digests.missing_by_digest(source, target, keys).select(
            F.lit(name).alias("table"), F.col(keys[0]).cast("bigint").alias("key"), "src_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


_DIGEST_SQL = " UNION ALL ".join(f"""
    SELECT '{name}' AS "table", (SELECT count(*) FROM {s}) AS source_rows, (SELECT count(*) FROM {t}) AS target_rows,
           (SELECT count(*) FROM (SELECT {sk[0]} FROM {s} EXCEPT SELECT {tk[0]} FROM {t})) AS keys_not_in_target,
           (SELECT count(*) FROM (SELECT {tk[0]} FROM {t} EXCEPT SELECT {sk[0]} FROM {s})) AS keys_not_in_source"""
    for name, (s, t, sk, tk, _) in PAIRS.items())
_MISSING_SQL = " UNION ALL ".join(f"""
    SELECT '{name}' AS "table", {sk[0]} AS key, count(*) AS src_rows FROM {s}
    WHERE {sk[0]} NOT IN (SELECT {tk[0]} FROM {t}) GROUP BY {sk[0]}""" for name, (s, t, sk, tk, _) in PAIRS.items())
ctes.add("pair_counts", _counts_sql())
_STALE = "\"table\" = 'hr_employee'"
ctes.add("verdicts", f"""
SELECT *, CASE WHEN {_STALE} THEN 'STALE' WHEN source_rows = 0 THEN 'NO_SOURCE_DATA' WHEN target_keys = source_rows THEN 'OK'
  WHEN target_keys = basis_rows THEN CASE WHEN unique_in_source THEN 'OK' ELSE 'OK_KEY_COLLAPSE' END
  WHEN abs(target_keys - basis_rows) * 100.0 / NULLIF(basis_rows, 0) <= 2.0 THEN 'OK_BOUNDARY' ELSE 'GAP' END AS verdict
FROM pair_counts
""")


def verdicts(spark, sf):
    return recon.classify_gap(counts(spark, sf), tolerance_pct=2.0, stale=F.col("table") == "hr_employee")


def frozen(spark, sf):
    orders = recon.frozen_window(a.table(spark, sf, "orders"), "o_orderdate", CUT, days=60, history_start="2001-05-01")
    lines = recon.frozen_window(a.table(spark, sf, "lineitem"), "l_shipdate", CUT, days=60, history_start="2001-05-01")
    return recon.layer_counts({"orders": orders, "lineitem": lines})


def lag(spark, sf):
    source = a.table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("t"))
    target = a.table(spark, sf, "orders").select(F.col("o_orderdate").alias("t"))
    return recon.freshness_lag(source, target, "t")


def absent(spark, sf, n=None):
    lines = a.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return recon.missing_keys(a.table(spark, sf, "orders"), lines, ["o_orderkey"], "o_orderdate", n)


def _detail(spark, sf):
    return reports.file_months(labelled(spark, sf), a.CUTOFF)


def day_proof_events(spark, sf):
    """Event days before the cutoff, rebuilt from month files."""
    rebuilt = recon.detail_day_counts(_detail(spark, sf), cohort=False).where(F.col("day") < a.CUTOFF)
    return rebuilt


def day_proof_cohort(spark, sf):
    return recon.detail_day_counts(_detail(spark, sf), cohort=True)


def month_proof(spark, sf):
    return recon.detail_month_counts(_detail(spark, sf))


def summary_side(spark, sf):
    return recon.summary_counts(whole_summary(spark, sf), "Day")


def differences(spark, sf):
    """Details against summary, both regimes: rows with all four differences, of days that differ in any."""
    detail = _detail(spark, sf)
    old = recon.detail_day_counts(detail, cohort=False).where(F.col("day") < a.CUTOFF)
    new = recon.detail_day_counts(detail, cohort=True).where(F.col("day") >= a.CUTOFF)
    rebuilt = old.unionByName(new).withColumn("period_key", F.col("day").cast("string"))
    summarised = recon.summary_counts(whole_summary(spark, sf), "Day")
    return recon.proof_differences(rebuilt, summarised, ["period_key", "vx_type"])


def conservation(spark, sf):
    whole = whole_summary(spark, sf)
    cohort_rows = whole.where((F.col("period_type") != "Day") | (F.col("snapshot_date") >= a.CUTOFF))
    return recon.conservation_violations(cohort_rows).agg(F.count(F.lit(1)).alias("violations"))


def layers(spark, sf):
    c = cells(spark, sf)
    return recon.layer_counts({
        "task_fact": labelled(spark, sf), "completion": completed(spark, sf), "day_summary": day_summary(c),
    })


def known_absent(spark, sf):
    """Null-safe tuple NOT IN on two columns, one of them with NULLs."""
    lines = a.table(spark, sf, "lineitem")
    source = lines.select("l_partkey", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"))
    target = lines.where("l_linestatus = 'F'").select(
        "l_partkey", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("flag"))
    return recon.missing_keys(source, target, ["l_partkey", "flag"], None, None).select("l_partkey", "flag", "src_rows")


def audited(spark, sf):
    """Orders against the orders that have lines (frozen window), and customers against orders, whose key they lack."""
    orders = a.table(spark, sf, "orders")
    lines = a.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    landed = orders.join(lines, "o_orderkey", "left_semi")
    cutoff = landed.agg(F.max("o_orderdate"))
    spec = TableSpec("orders", "orders", BATCH, "o_orderkey bigint, o_orderdate timestamp_ntz", ("o_orderkey",),
                     time_col="o_orderdate", history_start="1995-01-01")
    keyless = TableSpec("customer", "customer", FULL, "c_custkey bigint", ("o_custkey",))
    return recon.audit_table(spec, orders, landed, cutoff, days=400, tolerance_pct=0.5).unionByName(
        recon.audit_table(keyless, a.table(spark, sf, "customer"), orders))


_EVENTS = f"""
SELECT snapshot_date AS day, vx_type, count(*) AS total,
       count(CASE WHEN s = snapshot_date AND task_claim_date IS DISTINCT FROM snapshot_date
             AND task_end_date IS DISTINCT FROM snapshot_date THEN 1 END) AS todo,
       count(CASE WHEN task_claim_date = snapshot_date AND task_end_date IS DISTINCT FROM snapshot_date THEN 1 END) AS doing,
       count(CASE WHEN task_end_date = snapshot_date THEN 1 END) AS done
FROM (SELECT e.*, c.task_start_date AS s FROM event_rows e JOIN counted c ON e.task_id = c.task_id)
WHERE snapshot_date < DATE '{a.CUTOFF}' GROUP BY 1, 2
"""
CHECKS = [
    Check("digest_reconciliation", by_digest, _DIGEST_SQL),
    Check("digest_missing_keys", missing_by_digest, _MISSING_SQL),
    Check("reconcile_counts", counts, ctes.sql("SELECT * FROM pair_counts")),
    Check("gap_verdicts", verdicts, ctes.sql("SELECT * FROM verdicts")),
    Check("reconciliation_report", lambda s, d: recon.reconciliation_report(verdicts(s, d)), ctes.sql("""
        SELECT ord, category, "table", basis_rows AS source_rows, target_keys AS target_rows, missing, verdict,
               CASE WHEN missing = 0 THEN '100.00%' WHEN missing > 0
                    THEN printf('%.4f%%', least(target_keys * 100.0 / CAST(basis_rows AS DOUBLE), 99.9999))
                    ELSE printf('%.4f%%', target_keys * 100.0 / CAST(basis_rows AS DOUBLE)) END AS pct
        FROM verdicts JOIN (VALUES (4001, 'Workflow engine', 'taskinst'), (4002, 'Workflow engine', 'varinst'),
          (1000, 'People and organisation', 'hr_employee'), (2000, 'Master data', 'mdm_line_desc'),
          (2003, 'Master data', 'mdm_mfg_site'), (6000, 'Other', 'unlisted_table')) o(ord, category, name) ON "table" = name
        UNION ALL
        SELECT 1000000, 'Total', CAST(count(*) AS VARCHAR) || ' tables', CAST(sum(basis_rows) AS BIGINT),
               CAST(sum(target_keys) AS BIGINT), CAST(sum(missing) AS BIGINT), '',
               CASE WHEN sum(missing) = 0 THEN '100.00%' WHEN sum(missing) > 0
                    THEN printf('%.4f%%', least(sum(target_keys) * 100.0 / CAST(sum(basis_rows) AS DOUBLE), 99.9999))
                    ELSE printf('%.4f%%', sum(target_keys) * 100.0 / CAST(sum(basis_rows) AS DOUBLE)) END
        FROM verdicts""")),
    Check("audited_tables", audited, """
        WITH landed AS (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
        bound AS (SELECT greatest(max(o_orderdate) - INTERVAL '400' DAY, TIMESTAMP '1995-01-01') AS lo, max(o_orderdate) AS hi FROM landed),
        n AS (SELECT (SELECT count(*) FROM orders, bound WHERE o_orderdate >= lo AND o_orderdate < hi) AS s,
                     (SELECT count(*) FROM landed, bound WHERE o_orderdate >= lo AND o_orderdate < hi) AS t,
                     (SELECT date_diff('second', hi, (SELECT max(o_orderdate) FROM orders)) FROM bound) AS lag)
        SELECT 'orders' AS "table", true AS unique_in_source, s AS source_rows, s AS source_keys, t AS target_rows,
               t AS target_keys, s - t AS keys_not_in_target, s AS basis_rows, s - t AS missing,
               round(t * 100.0 / NULLIF(s, 0), 4) AS pct,
               CASE WHEN lag > 26 * 3600 THEN 'STALE' WHEN s = 0 THEN 'NO_SOURCE_DATA' WHEN t = s THEN 'OK'
                    WHEN (s - t) * 100.0 / s <= 0.5 THEN 'OK_BOUNDARY' ELSE 'GAP' END AS verdict, lag AS lag_seconds
        FROM n
        UNION ALL
        SELECT 'customer', true, (SELECT count(*) FROM customer), NULL, count(*), count(DISTINCT o_custkey), NULL,
               (SELECT count(*) FROM customer), (SELECT count(*) FROM customer) - count(DISTINCT o_custkey), 0.0,
               CASE WHEN count(DISTINCT o_custkey) = (SELECT count(*) FROM customer) THEN 'OK' ELSE 'SKIP_NO_KEY' END, NULL
        FROM orders"""),
    Check("frozen_window_counts", frozen, f"""
        SELECT 'orders' AS layer, count(*) AS row_count FROM orders
        WHERE o_orderdate >= greatest(TIMESTAMP '{CUT}' - INTERVAL '60' DAY, TIMESTAMP '2001-05-01') AND o_orderdate < TIMESTAMP '{CUT}'
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        WHERE l_shipdate >= greatest(TIMESTAMP '{CUT}' - INTERVAL '60' DAY, TIMESTAMP '2001-05-01') AND l_shipdate < TIMESTAMP '{CUT}'"""),
    Check("freshness_lag", lag, """
        SELECT s AS source_max, t AS target_max, date_diff('second', t, s) AS lag_seconds,
               date_diff('second', t, s) > 26 * 3600 AS stale
        FROM (SELECT max(l_shipdate) AS s FROM lineitem), (SELECT max(o_orderdate) AS t FROM orders)"""),
    Check("missing_keys", absent, """
        SELECT o_orderkey, min(o_orderdate) AS first_seen, count(*) AS src_rows FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1"""),
    Check("missing_keys_top20", lambda s, d: absent(s, d, 20), """
        SELECT o_orderkey, min(o_orderdate) AS first_seen, count(*) AS src_rows FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1 ORDER BY 1 LIMIT 20"""),
    Check("null_safe_tuple_not_in", known_absent, """
        SELECT l_partkey, NULLIF(l_returnflag, 'A') AS flag, count(*) AS src_rows FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F' AND f.l_partkey = l.l_partkey
                          AND f.l_returnflag = l.l_returnflag) GROUP BY 1, 2"""),
    Check("detail_day_proof_events", day_proof_events, ctes.sql(_EVENTS)),
    Check("detail_day_proof_cohort", day_proof_cohort, ctes.sql("""
        SELECT task_start_date AS day, vx_type, count(*) AS total, count(CASE WHEN status_daily = 'TODO' THEN 1 END) AS todo,
               count(CASE WHEN status_daily = 'DOING' THEN 1 END) AS doing,
               count(CASE WHEN status_daily = 'DONE' THEN 1 END) AS done FROM counted GROUP BY 1, 2""")),
    Check("detail_month_proof", month_proof, ctes.sql(f"""
        SELECT {month_key('task_start_date')} AS file_month, vx_type, count(*) AS total,
               count(CASE WHEN status_monthly = 'TODO' THEN 1 END) AS todo,
               count(CASE WHEN status_monthly = 'DOING' THEN 1 END) AS doing,
               count(CASE WHEN status_monthly = 'DONE' THEN 1 END) AS done FROM counted GROUP BY 1, 2""")),
    Check("summary_day_side", summary_side, ctes.sql("""
        SELECT period_key, vx_type, CAST(sum(total_qty) AS BIGINT) AS total, CAST(sum(todo_qty) AS BIGINT) AS todo,
               CAST(sum(doing_qty) AS BIGINT) AS doing, CAST(sum(done_qty) AS BIGINT) AS done
        FROM summary WHERE period_type = 'Day' GROUP BY 1, 2""")),
    Check("detail_summary_differences", differences, ctes.sql(f"""
        SELECT * FROM (
          SELECT period_key, vx_type, CAST(sum(total) AS BIGINT) AS total_diff, CAST(sum(todo) AS BIGINT) AS todo_diff,
                 CAST(sum(doing) AS BIGINT) AS doing_diff, CAST(sum(done) AS BIGINT) AS done_diff
          FROM (
            SELECT CAST(day AS VARCHAR) AS period_key, vx_type, total, todo, doing, done FROM ({_EVENTS}) AS events_side
            UNION ALL
            SELECT CAST(task_start_date AS VARCHAR), vx_type, count(*), count(CASE WHEN status_daily = 'TODO' THEN 1 END),
                   count(CASE WHEN status_daily = 'DOING' THEN 1 END), count(CASE WHEN status_daily = 'DONE' THEN 1 END)
            FROM counted WHERE task_start_date >= DATE '{a.CUTOFF}' GROUP BY 1, 2
            UNION ALL
            SELECT period_key, vx_type, -total_qty, -todo_qty, -doing_qty, -done_qty FROM summary WHERE period_type = 'Day')
          GROUP BY 1, 2)
        WHERE total_diff <> 0 OR todo_diff <> 0 OR doing_diff <> 0 OR done_diff <> 0""")),
    Check("conservation_violations", conservation, ctes.sql(f"""
        SELECT count(*) AS violations FROM summary WHERE (period_type <> 'Day' OR snapshot_date >= DATE '{a.CUTOFF}')
        AND todo_qty + doing_qty + done_qty <> total_qty""")),
    Check("boundary_profile", lambda s, d: recon.boundary_profile(whole_summary(s, d), a.CUTOFF), ctes.sql(f"""
        SELECT CASE WHEN snapshot_date < DATE '{a.CUTOFF}' THEN 'historical' ELSE 'current' END AS regime, period_type,
               min(snapshot_date) AS min_date, max(snapshot_date) AS max_date, count(*) AS row_count
        FROM summary GROUP BY 1, 2""")),
    Check("layer_row_counts", layers, ctes.sql("""
        SELECT 'task_fact' AS layer, count(*) AS row_count FROM fact UNION ALL SELECT 'completion', count(*) FROM completed
        UNION ALL SELECT 'day_summary', count(*) FROM day_rows""")),
]
