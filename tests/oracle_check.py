"""Run registered queries in Spark and their SQL in DuckDB; compare.

Compares row count, column names and types, and the multiset of rows
(columns sorted by name). Usable from pytest and as a script:

    python tests/oracle_check.py [sf_dir] [query ...]

Set ORACLE_EXACT=1 to compare floats without rounding and ORACLE_REPORT=<file>
to also write the per-query results as JSON.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if os.environ.get("ORACLE_EXACT") else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    import __spark_entry__ as E

    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types = [str(d[1]) for d in rel.description]
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    s_schema = sorted(zip(s_cols, [_SPARK_TO_DUCK.get(t, t) for t in s_types]))
    d_schema = sorted(zip(d_cols, d_types))
    res["schema_ok"] = s_schema == d_schema
    res["rows_ok"] = len(s_rows) == len(d_rows)
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_ok"] = a == b
    res["status"] = "ok" if (res["schema_ok"] and res["rows_ok"] and res["values_ok"]) else "FAIL"
    if verbose and res["status"] != "ok":
        if not res["schema_ok"]:
            print("  spark schema:", s_schema)
            print("  duck  schema:", d_schema)
        if not res["values_ok"]:
            diff_a = [r for r in a if r not in b][:5]
            diff_b = [r for r in b if r not in a][:5]
            print("  cols:", sorted(s_cols))
            print("  only spark:", diff_a)
            print("  only duck :", diff_b)
    return res


def main(argv):
    from medalla.session import get_spark
    import __spark_entry__ as E

    sf = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")] or list(E.queries())
    spark = get_spark("local[8]", 8)
    con = duck_connection(sf)
    bad = 0
    results = []
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": repr(e)[:400]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        results.append(r)
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    report = os.environ.get("ORACLE_REPORT")
    if report:
        import json

        with open(report, "w") as f:
            json.dump({"sf_dir": sf, "ok": len(names) - bad, "total": len(names), "queries": results}, f, indent=1)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
