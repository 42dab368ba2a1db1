"""Run registered Spark queries against their DuckDB oracle SQL.

Compares row count, column names and order-insensitive values exactly.
Usable from tests and as a script:

    python -m tests.oracle_compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, name: str, builder, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not res["columns_match"]:
        res["spark_columns"], res["oracle_columns"] = sorted(s_cols), sorted(d_cols)
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = res["columns_match"] and a == b
    if res["columns_match"] and not res["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diffs"] = diff
    res["ok"] = res["columns_match"] and res["values_match"]
    return res


def main(argv):
    sys.path.insert(0, ".")
    from tripmart.plans.queries import REGISTRY
    from tripmart.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [n for n, (_, sql) in REGISTRY.items() if sql]
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        fn, sql = REGISTRY[n]
        if sql is None:
            rows = fn(spark, sf_dir).count()
            print({"name": n, "spark_rows": rows, "oracle": None})
            continue
        r = compare(spark, sf_dir, n, fn, sql, con)
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
