"""Compare every registered query with its SQL twin: ``python tests/oracle.py [sf_dir] [keys]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["events", "orders", "documents", "labels", "benchmark", "embeddings"]


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(con, sql: str, df) -> str | None:
    """What differs between a Spark result and the SQL result; None if nothing does."""
    relation = con.sql(sql)
    if sorted(relation.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(relation.columns)}"
    got = canonical(df.columns, df.collect())
    want = canonical(relation.columns, relation.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows but SQL has {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry

    from conftest import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(entry.queries())
    spark, con, failed = build_session(os.environ.get("BENCH_CPUS", "8")), connection(sf_dir), 0
    sqls = entry.oracle_sql()
    for key in keys:
        began = time.time()
        df = entry.queries()[key](spark, sf_dir)
        if key in sqls:
            result = difference(con, sqls[key], df) or "equal"
            failed += result != "equal"
        else:
            result = f"{df.count()} rows (no SQL twin)"
        print(f"{key:24s} {time.time() - began:6.1f}s  {result}", flush=True)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    sys.exit(main())
