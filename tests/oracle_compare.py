"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names/types and the sorted rows exactly.
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

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def _arrow_type(t) -> str:
    s = str(t)
    if s in ("large_string", "string_view"):
        return "string"
    if s.startswith("timestamp"):
        return "timestamp" + ("_tz" if "tz=" in s else "")
    return s


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = pd.DataFrame(sdf.collect(), columns=sdf.columns)
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    odf = pd.DataFrame(cur.fetchall(), columns=names)
    res["oracle_rows"] = len(odf)
    if sorted(spdf.columns) != sorted(odf.columns):
        res["status"] = "COLUMNS"
        res["detail"] = f"spark={sorted(spdf.columns)} oracle={sorted(odf.columns)}"
        return res
    st = {f.name: _arrow_type(f.type) for f in sdf.toArrow().schema}
    ot = {f.name: _arrow_type(f.type) for f in con.sql(f"SELECT * FROM ({sql}) LIMIT 0").to_arrow_table().schema}
    if st != ot:
        res["status"] = "TYPES"
        res["detail"] = str({k: (st[k], ot.get(k)) for k in st if st[k] != ot.get(k)})
        return res
    a, b = rows_of(spdf), rows_of(odf)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    for ra, rb in zip(a, b):
        if ra != rb:
            cols = sorted(spdf.columns)
            diff = [(c, x, y) for c, x, y in zip(cols, ra, rb) if x != y]
            res["status"] = "VALUES"
            res["detail"] = str(diff[:6])
            return res
    res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from fareflow.session import get_session

    if os.environ.get("FAREFLOW_PLAIN_SESSION"):
        # a session with Spark's own defaults, as an outside caller would pass
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false") \
            .getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]")
    con = duck(sf_dir)
    qs, osql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, osql.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": repr(e)[:400]}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
