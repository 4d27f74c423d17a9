"""Compare a registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


_TYPE_MAP = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN", "double": "DOUBLE", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def spark_type_as_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.replace("decimal", "DECIMAL")
    return _TYPE_MAP.get(t, t.upper())


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, sf_dir: str, key: str, query, sql: str | None):
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = {"key": key, "spark_rows": len(s_rows)}
    if sql is None:
        res["ok"] = None
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["columns_ok"] = sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: spark_type_as_duck(f.dataType.simpleString()) for f in df.schema.fields}
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    res["types_ok"] = s_types == d_types
    if not res["types_ok"]:
        res["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types) if s_types.get(c) != d_types.get(c)}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_ok"] = a == b
    if not res["values_ok"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb, key=str)[:3]
        res["only_oracle"] = sorted(sb - sa, key=str)[:3]
        res["spark_cols"] = s_cols
        res["oracle_cols"] = d_cols
    res["ok"] = res["columns_ok"] and res["types_ok"] and res["values_ok"] and len(s_rows) == len(d_rows)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from tallyhawk.session import get_session
    import __spark_entry__ as E

    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        t0 = time.time()
        try:
            r = compare(spark, con, sf_dir, key, qs[key], sqls.get(key))
        except Exception as exc:  # report and continue
            r = {"key": key, "ok": False, "error": repr(exc)[:600]}
        r["sec"] = round(time.time() - t0, 2)
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
