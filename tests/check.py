"""Compare every query with its SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def ordered(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, query: str) -> str | None:
    """None when columns, types of cells and all values agree exactly."""
    got_names, got_rows = spark_df.columns, spark_df.collect()
    result = con.execute(query)
    want_names, want_rows = [d[0] for d in result.description], result.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(set(got_names) ^ set(want_names))[:6]}"
    if len(got_rows) != len(want_rows):
        return f"rows {len(got_rows)} != {len(want_rows)}"
    got, want = ordered(got_names, got_rows), ordered(want_names, want_rows)
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if not bad:
        return None
    g, w = bad[0]
    names = sorted(got_names)
    cells = [(n, a, b) for n, a, b in zip(names, g, w) if a != b or type(a) is not type(b)]
    return f"{len(bad)} of {len(got)} rows, first: {cells[:4]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from ledgercast.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
                       "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failures = connect(sf_dir), oracle_sql(), 0
    for name, make in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = make(spark, sf_dir)
            problem = difference(df, con, oracle[name]) if name in oracle else None
            rows = "" if name in oracle else f"rows only: {len(df.collect())}"
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {rows} {problem or ''}", flush=True)
    missing = set(oracle) - set(queries())
    print(f"failures: {failures}, queries: {len(queries())}, with SQL: {len(oracle)}, SQL without query: {missing}")
    return failures


if __name__ == "__main__":
    sys.exit(main())
