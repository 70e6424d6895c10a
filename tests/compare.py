"""Run registered queries next to their SQL form and compare rows and types.

``python -m tests.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import contextlib
import glob
import io
import os
import sys
import time
import traceback

import duckdb
import pandas as pd


spent: list[float] = []


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(table: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return (1, "")
        if isinstance(v, float):
            return (0, repr(0.0 if v == 0 else v))
        return (0, str(v))

    ordered = table[sorted(table.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False))


def kinds(schema) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in schema}


def crossings(frame) -> list[str]:
    """Joins without an equality that the plan of a query holds."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return [j for j in ("CartesianProduct", "BroadcastNestedLoopJoin") if j in text.getvalue()]


def compare(spark, con, sf_dir: str, fn, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    start = time.time()
    frame = fn(spark, sf_dir)
    result = frame.toArrow()
    spent.append(time.time() - start)
    if crossing := crossings(frame):
        return f"plan has {crossing}"
    if sql is None:
        return None if result.num_rows else "no rows"
    wanted = con.sql(sql).to_arrow_table()
    mine, theirs = kinds(result.schema), kinds(wanted.schema)
    if mine != theirs:
        return f"types {mine} != {theirs}"
    a = normal(result.to_pandas(types_mapper=pd.ArrowDtype))
    b = normal(wanted.to_pandas(types_mapper=pd.ArrowDtype))
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main() -> int:
    sys.path.insert(0, os.getcwd())
    import __spark_entry__ as entry
    from textloom.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
        spark__sql__warehouse__dir="/tmp/textloom-warehouse", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, queries[name], sql.get(name))
        except Exception as e:  # report and go on with the next query
            problem = str(e)[:1500] if not os.environ.get("TRACE") else traceback.format_exc()
        kind = "sql" if name in sql else "rows"
        print(f"{'ok  ' if not problem else 'FAIL'} {name:24s} {kind:4s} {spent[-1] if spent else 0:6.2f}s of {time.time() - start:6.2f}s {problem or ''}", flush=True)
        failed += bool(problem)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
