"""Side-by-side check of a Spark query and its DuckDB SQL (row count, column
names, order-insensitive values).  Used by the tests and by hand."""

from __future__ import annotations

import math

import pandas as pd

from portrait.sources.tables import TABLES


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm_value(v.item(), digits)
        except Exception:
            pass
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return tuple(_norm_value(x, digits) for x in list(v))
    return v


def normalize(pdf: pd.DataFrame, digits: int = 6) -> list:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm_value(r[c], digits) for c in cols) for r in pdf.to_dict("records")]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def _types(schema) -> dict:
    norm = {"large_string": "string", "large_binary": "binary"}
    return {f.name: norm.get(str(f.type), str(f.type)) for f in schema}


def compare(spark_df, con, sql: str, digits: int = 6) -> dict:
    """Both sides are fetched once as Arrow: column types are compared at the
    Arrow level, values after conversion to Python objects."""
    sa = spark_df.toArrow()
    da = con.sql(sql).to_arrow_table()
    s, d = sa.to_pandas(), da.to_pandas()
    res = {"rows_spark": len(s), "rows_oracle": len(d),
           "cols_spark": sorted(s.columns), "cols_oracle": sorted(d.columns)}
    res["cols_match"] = res["cols_spark"] == res["cols_oracle"]
    ts, td = _types(sa.schema), _types(da.schema)
    res["type_diff"] = {c: (ts[c], td.get(c)) for c in ts if td.get(c) != ts[c]}
    res["types_match"] = not res["type_diff"]
    res["rows_match"] = len(s) == len(d)
    res["values_match"] = res["cols_match"] and normalize(s, digits) == normalize(d, digits)
    if not res["values_match"] and res["cols_match"]:
        ns, nd = normalize(s, digits), normalize(d, digits)
        res["diff_spark_only"] = [r for r in ns if r not in set(nd)][:3]
        res["diff_oracle_only"] = [r for r in nd if r not in set(ns)][:3]
    return res
