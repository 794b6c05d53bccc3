"""Spark-vs-DuckDB comparison in the driver's style (row count, column names,
order-insensitive values). Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["match"] = None
        return res
    con = con or duck(sf_dir)
    dpdf = con.execute(sql).df()
    res["duck_rows"] = len(dpdf)
    res["columns_match"] = sorted(spdf.columns) == sorted(dpdf.columns)
    if not res["columns_match"]:
        res["match"] = False
        res["detail"] = f"spark {sorted(spdf.columns)} vs duck {sorted(dpdf.columns)}"
        return res
    a, b = _rows(spdf), _rows(dpdf)
    res["match"] = a == b
    if not res["match"]:
        diff_a = [r for r in a if r not in set(b)][:3] if len(a) < 200000 else []
        diff_b = [r for r in b if r not in set(a)][:3] if len(b) < 200000 else []
        res["detail"] = f"cols {sorted(spdf.columns)} only-spark {diff_a} only-duck {diff_b}"
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tidemark.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"name": name, "match": False, "detail": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("match") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
