"""Compare each registered Spark query with its DuckDB SQL.

Usable from pytest and as a script:
``python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editpulse.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: repr(r))
    return cols, out


# Spark type -> DuckDB type name of the same values.
_DUCK_TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR",
               "DoubleType": "DOUBLE", "TimestampNTZType": "TIMESTAMP",
               "TimestampType": "TIMESTAMP WITH TIME ZONE", "DateType": "DATE",
               "BooleanType": "BOOLEAN"}


def spark_types(df) -> dict:
    return {f.name: _DUCK_TYPES.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None):
    t0 = time.time()
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(s_rows), "match": None, "spark_sec": t1 - t0}
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    types_ok = spark_types(df) == d_types
    ok = sc == dc and sr == dr and types_ok
    info = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "match": ok,
            "spark_sec": round(t1 - t0, 3)}
    if not types_ok:
        info["spark_types"] = spark_types(df)
        info["oracle_types"] = d_types
    if not ok:
        info["spark_cols"] = sc
        info["oracle_cols"] = dc
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        info["spark_only"] = diff_s
        info["oracle_only"] = diff_d
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from editpulse.session import local_session
    import __spark_entry__ as entry

    spark = local_session()
    con = duck(sf_dir)
    qs = entry.queries()
    sqls = entry.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        info = compare(spark, con, sf_dir, name, qs[name], sqls.get(name))
        print(info, flush=True)
        if info["match"] is False:
            bad += 1
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
