"""Run registered queries in Spark and their SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name ...]
       CHECK_TZ=America/Los_Angeles ...   (another session time zone)
       CHECK_ANSI=false ...                (ANSI mode off)

Comparison: same column names, same column types (Spark type mapped to
the DuckDB name), same row count, same multiset of rows (values
normalised: floats rounded to 9 digits, timestamps as text).  One JSON
line per query; exit status 0 when all match.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stationlake.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402
from stationlake.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


_SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
                  "timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "date": "DATE",
                  "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, sf_dir, name):
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(_norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(ORACLE_SQL[name])
    ocols = res.columns
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = [tuple(_norm(r[i]) for i in order) for r in res.fetchall()]
    stypes = {c: _SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    otypes = {c: str(t) for c, t in zip(ocols, res.types)}
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(orows),
           "cols_match": sorted(sdf.columns) == sorted(ocols),
           "types_match": stypes == otypes,
           "spark_sec": round(t1 - t0, 2)}
    if not out["types_match"]:
        out["type_diff"] = {c: (stypes.get(c), otypes.get(c)) for c in set(stypes) | set(otypes)
                            if stypes.get(c) != otypes.get(c)}
    out["values_match"] = sorted(srows, key=_key) == sorted(orows, key=_key)
    if not out["values_match"]:
        a, b = set(srows), set(orows)
        out["only_spark"] = [list(x) for x in list(a - b)[:3]]
        out["only_oracle"] = [list(x) for x in list(b - a)[:3]]
        out["spark_cols"] = sorted(sdf.columns)
        out["oracle_cols"] = sorted(ocols)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    extra = {}
    if os.environ.get("CHECK_TZ"):  # run under another session zone
        extra["spark.sql.session.timeZone"] = os.environ["CHECK_TZ"]
    if os.environ.get("CHECK_ANSI"):  # run with ANSI mode on or off
        extra["spark.sql.ansi.enabled"] = os.environ["CHECK_ANSI"]
    spark = build_session("local[8]", 8, extra=extra)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    ok = True
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and go on
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok &= bool(r.get("values_match")) and bool(r.get("cols_match")) and bool(r.get("types_match"))
        print(json.dumps(r, default=str), flush=True)
    spark.stop()
    sys.exit(0 if ok else 1)


if __name__ == "__main__":
    main()
