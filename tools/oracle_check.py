"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [query ...]
Prints one line per query: rows, schema and value match.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from syncforge.plans.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, np.ndarray):
        return tuple(v.tolist())
    if isinstance(v, np.generic):
        return _norm(v.item())
    if isinstance(v, list):
        return tuple(v)
    return v


def rows_of(pdf: pd.DataFrame) -> list:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (x is pd.NaT) else x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    if sql is None:
        return dict(name=name, rows=len(spdf), oracle=None, spark_s=round(t1 - t0, 2))
    opdf = con.execute(sql).df()
    res = dict(name=name, rows=len(spdf), oracle_rows=len(opdf), spark_s=round(t1 - t0, 2))
    res["schema"] = sorted(spdf.columns) == sorted(opdf.columns)
    if not res["schema"]:
        res["cols"] = (sorted(spdf.columns), sorted(opdf.columns))
        res["values"] = False
        return res
    a, b = rows_of(spdf), rows_of(opdf)
    res["values"] = a == b
    if not res["values"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
    return res


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from syncforge.plans import ORACLE, QUERIES
    from syncforge.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, error=repr(e)[:800])
        ok = r.get("values") is True or (r.get("oracle") is None and "error" not in r and "values" not in r)
        bad += 0 if ok else 1
        print(("OK   " if ok else "FAIL ") + str(r), flush=True)
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
