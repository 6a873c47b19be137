"""Side-by-side check of a Spark query against its DuckDB SQL oracle.

Same contract as the driver: row count, column names (sorted) and an
order-insensitive hash of the values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = os.environ.get("TIDEMARK_EXACT", "1") == "1"  # exact floats and decimals by default


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if EXACT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if EXACT else round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def digest(columns, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), names, h


_SPARK_FAMILIES = (("decimal", "decimal"), ("bigint", "int"), ("int", "int"), ("smallint", "int"),
                   ("double", "float"), ("float", "float"), ("string", "string"), ("timestamp", "timestamp"),
                   ("date", "date"), ("boolean", "bool"), ("array", "list"), ("void", "null"))
_DUCK_FAMILIES = (("DECIMAL", "decimal"), ("HUGEINT", "int"), ("BIGINT", "int"), ("INTEGER", "int"),
                  ("SMALLINT", "int"), ("DOUBLE", "float"), ("FLOAT", "float"), ("VARCHAR", "string"),
                  ("TIMESTAMP", "timestamp"), ("DATE", "date"), ("BOOLEAN", "bool"), ("NULL", "null"))


def type_families(spark_schema, duck_rel) -> dict:
    """Columns whose broad type family (int, float, decimal, string, ...)
    differs between the Spark result and the DuckDB result."""
    def fam(t, table):
        if t.endswith("[]"):
            return "list"
        for prefix, f in table:
            if t.startswith(prefix):
                return f
        return t
    s = {f.name: fam(f.dataType.simpleString().lower(), _SPARK_FAMILIES) for f in spark_schema.fields}
    d = {c: fam(str(t).upper(), _DUCK_FAMILIES) for c, t in zip(duck_rel.columns, duck_rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark, sf_dir: str, fn, sql: str):
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, s_rows)
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    d = digest(d_cols, d_rows)
    return s, d, (df.columns, s_rows), (d_cols, d_rows)


def explain_mismatch(s_full, d_full, limit=5):
    (sc, sr), (dc, dr) = s_full, d_full
    order_s = sorted(range(len(sc)), key=lambda i: sc[i])
    order_d = sorted(range(len(dc)), key=lambda i: dc[i])
    ss = {repr(tuple(_norm(r[i]) for i in order_s)) for r in sr}
    dd = {repr(tuple(_norm(r[i]) for i in order_d)) for r in dr}
    only_s = sorted(ss - dd)[:limit]
    only_d = sorted(dd - ss)[:limit]
    return [sc[i] for i in order_s], only_s, only_d
