"""Runs registered queries next to their SQL counterparts and compares the results.

python tests/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    want_columns, want = _rows(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first:\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    return None


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    import __spark_entry__ as entry
    from roadpulse.session import build_session

    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(opts.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in opts.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, opts.sf)
            if name in oracles:
                built = time.time()
                problem = compare(df, con, oracles[name])
            else:
                built = time.time()
                problem = None if df.count() > 0 else "no rows"
        except Exception as exc:  # noqa: BLE001
            built, problem = time.time(), f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += problem is not None
        kind = "oracle" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} ({kind}, {time.time() - start:.1f}s)", problem or "", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
