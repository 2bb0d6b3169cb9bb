"""Run registered queries in Spark and their SQL twins in DuckDB; compare
row counts, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 6))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (list, tuple)):
        return (3, tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return (3, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return (4, str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = dict(name=name, rows=len(s_rows), duck_rows=len(d_rows), spark_s=round(t1 - t0, 2))
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, why=f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
        return res
    if len(s_rows) != len(d_rows):
        res.update(ok=False, why="row count")
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res.update(ok=False, why=f"values differ e.g. {bad}")
        return res
    res.update(ok=True)
    return res


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from tidewatch.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for n in (names or list(qs)):
        try:
            r = compare(spark, con, n, qs[n], sql.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=n, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("ok") is False:
            fails += 1
        print(r, flush=True)
    print(f"FAILS {fails} of {len(names or qs)}")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
