"""Compare catalogue queries with their DuckDB SQL on the same tables.

Row count, column names (sorted) and an order-insensitive hash of the values.
Used by the tests and by ``scripts/check_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
from dataclasses import dataclass

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _canon(v) -> str:
    if v is None:
        return "∅"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return "T" if v else "F"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(float(v))
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


@dataclass
class Result:
    name: str
    rows_spark: int
    rows_oracle: int
    cols_match: bool
    hash_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.rows_spark == self.rows_oracle and self.cols_match and self.hash_match


def _digest(cols: list[str], rows: list[tuple]) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> Result:
    con = con or duckdb_connection(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    h1, l1 = _digest(s_cols, s_rows)
    h2, l2 = _digest(o_cols, o_rows)
    detail = ""
    if h1 != h2:
        only_s = sorted(set(l1) - set(l2))[:3]
        only_o = sorted(set(l2) - set(l1))[:3]
        detail = f"spark-only {only_s} oracle-only {only_o}"
    cols_ok = sorted(s_cols) == sorted(o_cols)
    if not cols_ok:
        detail = f"cols spark={sorted(s_cols)} oracle={sorted(o_cols)} " + detail
    return Result(name, len(s_rows), len(o_rows), cols_ok, h1 == h2, detail)
