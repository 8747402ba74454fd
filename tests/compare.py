"""Run registered queries against their comparison SQL: ``python tests/compare.py [sf] [names...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    """A comparable, sortable form that keeps types apart."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, datetime.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise what differs first."""
    frame = query(spark, sf_dir)
    left = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    right = canonical([d[0] for d in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return " ; ".join(f"{c}: {x} / {y}" for c, x, y in zip(left[0], a, b) if x != y)
    return None if left[1] or name in EMPTY_IS_FINE else "both empty"


EMPTY_IS_FINE: set[str] = set()

if __name__ == "__main__":
    import __spark_entry__ as entry
    from emberlog.session import local_session

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark, con = local_session(), database(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        if name not in sqls:
            rows = len(queries[name](spark, sf).collect())
            print(f"rows  {name} {rows} {time.time() - start:.2f}s", flush=True)
            continue
        try:
            difference = compare(spark, con, name, queries[name], sqls[name], sf)
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:400]}"
        bad += difference is not None
        print(f"{'ok   ' if difference is None else 'DIFF '} {name} {time.time() - start:.2f}s {difference or ''}", flush=True)
    print(f"{bad} different")
