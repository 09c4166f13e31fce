"""Spark-versus-DuckDB comparison of registered queries (what the driver's gate does).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~null",)
        return ("f", float(f"{v:.12g}"))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v)) if abs(v) < 2**53 else ("i", v)
    if isinstance(v, pd.Timestamp):
        return ("t", v.to_pydatetime().replace(tzinfo=None))
    return ("s", str(v)) if not hasattr(v, "isoformat") else ("t", v)


def rows_of(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=repr)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    sp = sdf.toPandas()
    ts = time.time() - t0
    if sql is None:
        return {"key": key, "ok": None, "rows": len(sp), "sec": round(ts, 2)}
    dd = con.execute(sql).df()
    res = {"key": key, "rows": len(sp), "oracle_rows": len(dd), "sec": round(ts, 2)}
    if sorted(sp.columns) != sorted(dd.columns):
        res.update(ok=False, why=f"columns {sorted(sp.columns)} vs {sorted(dd.columns)}")
        return res
    a, b = rows_of(sp), rows_of(dd)
    if a == b:
        res["ok"] = True
    else:
        res["ok"] = False
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["why"] = f"spark-only {diff_a} | oracle-only {diff_b}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, con, k, qs[k], orc.get(k), sf_dir)
        except Exception as e:  # report and go on
            r = {"key": k, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
