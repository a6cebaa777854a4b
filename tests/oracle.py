"""Run registered queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _text(value) -> str:
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def rows(names, records) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in records)


def compare(spark, con, run, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = rows(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not want:
        return "the oracle has no rows"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {str(bad[0])[:600]}" if bad else None


if __name__ == "__main__":
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
    from __spark_entry__ import oracle_sql, queries
    from tidewell.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    rows_limit = os.environ.get("TASK_ROWS")
    extra = {"spark.tidewell.taskRows": rows_limit} if rows_limit else {}
    spark = build_session("oracle", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", **extra})
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, run, sqls.get(name), folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "" if name in sqls else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{kind} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
