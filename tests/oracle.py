"""Compare registered queries with their SQL, run by DuckDB on the same files."""

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connection(folder):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(x):
    """One spelling for equal values; the type of a number counts."""
    if x is None:
        return None
    if isinstance(x, float):
        return "nan" if math.isnan(x) else ("d", round(x, 9))
    if isinstance(x, (bytes, bytearray)):
        return bytes(x)
    if isinstance(x, (datetime.datetime, decimal.Decimal, bool, int, str)):
        return x
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    if hasattr(x, "asDict"):
        return plain(x.asDict())
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return x


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, folder, name, query, sql):
    """None if both agree, else what differs."""
    df = query(spark, folder)
    columns, got = table_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    with connection(folder) as con:
        result = con.execute(sql)
        names = [c[0] for c in result.description]
        want_columns, want = table_of(names, result.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows against {len(want)}; extra {extra}; missing {missing}"
    return None if want else "no rows"
