"""Compare queries with their SQL on DuckDB: ``python tests/comparison.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def sql_engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (int, Decimal)):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    from cropweave.workload import ORACLES, QUERIES

    t0 = time.time()
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if name not in ORACLES:
        return bool(got[1]), f"{name}: {len(got[1])} rows, no SQL"
    cur = con.execute(ORACLES[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    t2 = time.time()
    note = f"{name}: {len(got[1])} rows, {t1 - t0:.1f}s / sql {t2 - t1:.1f}s"
    if got[0] != want[0]:
        return False, f"{note}\n  columns {got[0]}\n  expected {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        lacking = [r for r in want[1] if r not in set(got[1])][:3]
        return False, f"{note} vs {len(want[1])}\n  only here {extra}\n  only sql  {lacking}"
    return True, note


if __name__ == "__main__":
    from cropweave.session import build_session
    from cropweave.workload import QUERIES

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    session = build_session("comparison", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("OFF")
    bad = 0
    for query in sys.argv[2:] or list(QUERIES):
        try:
            ok, text = compare(session, sql_engine(folder), query, folder)
        except Exception as e:  # noqa: BLE001
            ok, text = False, f"{query}: {type(e).__name__} {str(e)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", text, flush=True)
    print(f"{bad} failed")
