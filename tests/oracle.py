"""Compare a Spark result with DuckDB SQL over the same parquet tables:
row count, column names, and the order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("num", float(v))
    if isinstance(v, float):
        return ("num", None) if math.isnan(v) else ("num", round(v, 6))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", float(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("str", str(v))


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


# Spark type -> DuckDB type of an equal column
TYPE_MAP = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "decimal(18,1)": "DECIMAL(18,1)",
}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = spark_df.columns
    stypes = dict(spark_df.dtypes)
    srows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: spark={sorted(cols)} oracle={sorted(ocols)}"
    bad_types = {c: (stypes[c], otypes[c]) for c in cols if TYPE_MAP.get(stypes[c], stypes[c]) != otypes[c]}
    if bad_types:
        return False, f"types differ: {bad_types}"
    if len(srows) != len(orows):
        return False, f"row count differs: spark={len(srows)} oracle={len(orows)}"
    order = sorted(cols)
    sidx = [cols.index(c) for c in order]
    oidx = [ocols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in sidx) for r in srows), key=_key)
    o = sorted((tuple(_norm(r[i]) for i in oidx) for r in orows), key=_key)
    for a, b in zip(s, o):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(order, a, b) if x != y]
            return False, f"value differs: {str(diff)[:600]}"
    return True, f"{len(srows)} rows"
