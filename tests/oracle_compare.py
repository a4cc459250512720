"""Run a registered query in Spark and its SQL oracle in DuckDB; compare.

Comparison is order-insensitive: columns by name (with matching types),
rows as sorted tuples, values exact (money is rounded before it becomes
DOUBLE on both sides).
"""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", v) if not math.isnan(v) else ("f", "nan")
    if isinstance(v, (_dt.datetime, _dt.date)):
        return ("d", v.isoformat()[:10] if type(v) is _dt.date else v.isoformat())
    if v is None:
        return ("n", "")
    return (type(v).__name__, v)


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark type -> DuckDB type of the same values
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR"}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if s_types != d_types:
        return False, f"types differ: spark={s_types} duck={d_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows"
