"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values with columns sorted by name.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck_connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def run(sf_dir, names=None, spark=None):
    import __spark_entry__ as E
    from samplewright.session import get_session

    spark = spark or get_session("local[3]", shuffle_partitions=6)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    report = {}
    for name in names or sorted(qs):
        entry = {}
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            entry.update(spark_rows=len(rows), spark_sec=round(time.time() - t0, 2))
        except Exception as e:  # noqa: BLE001
            entry["spark_error"] = repr(e)[:500]
            report[name] = entry
            print(name, entry, flush=True)
            continue
        if name in sqls:
            try:
                rel = con.sql(sqls[name])
                dcols = rel.columns
                drows = rel.fetchall()
                entry.update(duck_rows=len(drows),
                             cols_match=sorted(cols) == sorted(dcols),
                             hash_match=digest(cols, rows) == digest(dcols, drows))
                if not entry["cols_match"]:
                    entry["cols"] = [sorted(cols), sorted(dcols)]
            except Exception as e:  # noqa: BLE001
                entry["duck_error"] = repr(e)[:800]
        else:
            entry["oracle"] = "none"
        report[name] = entry
        print(name, json.dumps(entry), flush=True)
    return report


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(sf, sys.argv[2:] or None)
