"""Run registered queries against their DuckDB oracle (the driver's correctness gate).

Usage: ``python tests/oracle_harness.py [sf_dir] [key ...]``. Prints one line per key.
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df, cols):
    out = []
    for row in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in row))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    sp = sdf.toPandas()
    t1 = time.time()
    sql = oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(sp), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    od = rel.df()
    same = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    tdiff = {c: (stypes.get(c), otypes.get(c)) for c in stypes
             if same.get(stypes[c], stypes[c].upper()) != otypes.get(c)}
    if tdiff:
        res["types"] = tdiff
    res["oracle_rows"] = len(od)
    sc, oc = sorted(sp.columns), sorted(od.columns)
    if sc != oc:
        res["status"] = f"schema mismatch spark={sc} oracle={oc}"
        return res
    a, b = _rows(sp, sc), _rows(od, sc)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"value mismatch ({len(a)} vs {len(b)} rows) first diffs {diff}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import queries
    from sensorlytics.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    keys = argv[2:] or list(queries())
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
