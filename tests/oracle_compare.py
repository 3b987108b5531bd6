"""Run registered Spark queries and their DuckDB oracle side by side and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: column names (sorted), mapped types, row count, and the multiset of rows.
'exact' compares values as returned; 'tolerant' rounds floats to 6 decimals.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v, tolerant: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) if tolerant else v
    if isinstance(v, decimal.Decimal):
        return float(v) if not tolerant else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, tolerant) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, tolerant)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(), tolerant)
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = dict(sdf.dtypes)
    s_rows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols, r)) for r in res.fetchall()]
    d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({sql})").fetchall()}
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    s_cols, o_cols = sorted(s_types), sorted(d_cols)
    out["columns_match"] = s_cols == o_cols
    if not out["columns_match"]:
        out["columns"] = {"spark_only": sorted(set(s_cols) - set(o_cols)), "oracle_only": sorted(set(o_cols) - set(s_cols))}
        return out
    type_diff = {c: (s_types[c], d_types.get(c)) for c in s_cols
                 if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types.get(c)}
    out["types_match"] = not type_diff
    if type_diff:
        out["type_diff"] = type_diff
    for mode in ("exact", "tolerant"):
        tol = mode == "tolerant"
        a = Counter(tuple(norm(r[c], tol) for c in s_cols) for r in s_rows)
        b = Counter(tuple(norm(r[c], tol) for c in s_cols) for r in d_rows)
        out[mode] = a == b
        if a != b and tol:
            only_s = list((a - b).elements())[:3]
            only_o = list((b - a).elements())[:3]
            out["sample_spark_only"] = [dict(zip(s_cols, r)) for r in only_s]
            out["sample_oracle_only"] = [dict(zip(s_cols, r)) for r in only_o]
    return out


def main():
    import json
    from marketlake.session import build_session
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = build_session()
    con = duck_conn(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    names = args or list(qs)
    bad = 0
    for n in names:
        if n not in oracle:
            sdf = qs[n](spark, sf_dir)
            print(json.dumps({"name": n, "rows_only": sdf.count()}))
            continue
        try:
            r = compare(spark, con, n, qs[n], oracle[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = r.get("exact") and r.get("types_match")
        bad += 0 if ok else 1
        print(("OK   " if ok else "FAIL ") + json.dumps(r, default=str))
    print(f"{len(names) - bad}/{len(names)} exact matches")


if __name__ == "__main__":
    main()
