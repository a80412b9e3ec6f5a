"""Run checks against DuckDB: ``python -m checks.runner [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

from checks import adapter as a


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if v != v else f"{v:.9g}"
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in a.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, check) -> tuple[str, str]:
    df = check.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if check.sql is None:
        return "rows", f"{len(got)} rows"
    cursor = con.execute(check.sql)
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return "FAIL", f"columns {sorted(set(df.columns) ^ set(columns))}"
    left, right = canonical(got, df.columns), canonical(expected, columns)
    if left != right:
        only_left, only_right = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
        return "FAIL", f"spark {len(left)} rows {only_left} / oracle {len(right)} rows {only_right}"
    return "ok", f"{len(left)} rows"


def main(argv: list[str]) -> int:
    from checks.registry import CHECKS
    from cohortmill.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = build_session("checks", 8, **{"spark.driver.memory": "8g"})
    con = oracle_connection(sf_dir)
    failures = 0
    for check in CHECKS:
        if wanted and check.name not in wanted:
            continue
        began = time.perf_counter()
        try:
            state, note = compare(spark, con, sf_dir, check)
        except Exception as error:  # report and go on to the next check
            state, note = "ERROR", str(error)[:1500]
        failures += state in ("FAIL", "ERROR")
        print(f"{state:5} {check.name:38} {time.perf_counter() - began:6.2f}s {note}", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
