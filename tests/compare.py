"""Spark result vs DuckDB twin: row count, column names and values, order-insensitive."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


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
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return [cols[i] for i in order], out


_EXACT = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
          "BooleanType": "BOOLEAN", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP",
          "TimestampType": "TIMESTAMP WITH TIME ZONE", "FloatType": "FLOAT", "ShortType": "SMALLINT",
          "ByteType": "TINYINT"}


def _spark_exact(dt) -> str:
    return _EXACT.get(type(dt).__name__, str(dt))


def _spark_family(dt) -> str:
    n = type(dt).__name__
    return {"ByteType": "int", "ShortType": "int", "IntegerType": "int", "LongType": "int",
            "FloatType": "float", "DoubleType": "float", "DecimalType": "decimal", "StringType": "str",
            "BooleanType": "bool", "DateType": "date", "TimestampType": "ts", "TimestampNTZType": "ts"}.get(n, n)


def _duck_family(t: str) -> str:
    t = str(t).upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t == "VARCHAR":
        return "str"
    if t == "BOOLEAN":
        return "bool"
    if t == "DATE":
        return "date"
    if t.startswith("TIMESTAMP"):
        return "ts"
    return t


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_types = {f.name: _spark_family(f.dataType) for f in spark_df.schema.fields}
    s_exact = {f.name: _spark_exact(f.dataType) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: _duck_family(d[1]) for d in res.description}
    d_exact = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns spark={sc} duck={dc}")
    bad_t = {c: (s_types[c], d_types[c]) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    if bad_t:
        problems.append(f"types spark/duck {bad_t}")
    bad_x = {c: (s_exact[c], d_exact[c]) for c in s_exact if c in d_exact and s_exact[c] != d_exact[c]}
    if bad_x and not bad_t:
        problems.append(f"exact types spark/duck {bad_x}")
    if len(sr) != len(dr):
        problems.append(f"rows spark={len(sr)} duck={len(dr)}")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b]
        problems.append(f"{len(bad)} differing rows, first: {bad[0]}")
    return problems, len(sr)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from assetflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import os
    spark = build_session(os.environ.get("CMP_MASTER", "local[8]"), shuffle_partitions=int(os.environ.get("CMP_SHUFFLE", "8")))
    con = duck(sf_dir)
    sql = E.oracle_sql()
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        df = fn(spark, sf_dir)
        if name not in sql:
            n = df.count()
            print(f"{name:28s} rows-only {n} rows {time.time()-t:.1f}s", flush=True)
            continue
        probs, n = compare(df, con, sql[name])
        print(f"{name:28s} {'OK ' if not probs else 'BAD'} {n} rows {time.time()-t:.1f}s {probs if probs else ''}",
              flush=True)
