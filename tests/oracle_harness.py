"""Run registered queries against their DuckDB oracles, as the driver does.

    python tests/oracle_harness.py [sf_dir] [key ...]

Compares row count, column names (sorted) and the multiset of rows.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(rec[i]) for i in order) for rec in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


def type_mismatches(sdf, con, sql):
    d_types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    return {c: (t, d_types.get(c)) for c, t in sdf.dtypes if SPARK_TO_DUCK.get(t, t) != d_types.get(c)}


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    types = type_mismatches(sdf, con, sql)
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    return {"key": key, "cols": ok_cols, "rows": ok_n, "values": ok_v, "types": types, "n_spark": len(s_rows),
            "n_oracle": len(d_rows), "spark_cols": s_cols, "oracle_cols": d_cols, "sec": round(t1 - t0, 2)}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from earworm.session import build_session
    import __spark_entry__ as e

    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if wanted and key not in wanted:
            continue
        if key not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"{key:32s} rows-only n={n} {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            res = compare(spark, con, key, fn, sqls[key], sf_dir)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{key:32s} ERROR {type(exc).__name__}: {str(exc)[:400]}", flush=True)
            continue
        flag = "OK " if res["values"] else "BAD"
        bad += flag == "BAD"
        print(f"{key:32s} {flag} n={res['n_spark']}/{res['n_oracle']} cols={res['cols']} "
              f"{res['sec']}s" + ("" if res["cols"] else f" {res['spark_cols']} vs {res['oracle_cols']}")
              + (f" TYPES {res['types']}" if res["types"] else ""), flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
