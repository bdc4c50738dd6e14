"""Compare a registered query with its SQL twin run by DuckDB (tests/tools).

Values are normalised before comparing: columns sorted by name, decimals and
floats rounded to 6 places, temporal values as ISO text, rows sorted.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from typing import Any

from tripmart.sources.tables import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v: Any) -> Any:
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> dict:
    con = con or duckdb_connection(sf_dir)
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols, s_rows = normalise(sdf.columns, s_rows)
    rel = con.sql(sql)
    o_cols, o_rows = normalise(list(rel.columns), rel.fetchall())
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": s_cols == o_cols, "values_match": s_rows == o_rows}
    if not res["columns_match"]:
        res["spark_columns"], res["oracle_columns"] = s_cols, o_cols
    elif not res["values_match"]:
        so, oo = set(s_rows), set(o_rows)
        res["only_spark"] = sorted(so - oo, key=str)[:3]
        res["only_oracle"] = sorted(oo - so, key=str)[:3]
    res["ok"] = res["columns_match"] and res["values_match"]
    return res
