"""Run a Spark DataFrame and a DuckDB text side by side and compare results.

Columns are compared by name (sorted), rows as an order-insensitive multiset
of normalised values. Used by the tests; it mirrors the external check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

from pipewright.sources.tables import TABLES, path


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
        if isinstance(v, np.ndarray):
            return repr([_norm(x) for x in v.tolist()])
    except ImportError:
        pass
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def compare(df, con, sql, show: int = 5) -> dict:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    out = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
           "spark_cols": sc, "oracle_cols": dc}
    cs, cd = Counter(sr), Counter(dr)
    out["values_match"] = cs == cd
    if cs != cd:
        out["only_spark"] = list((cs - cd).elements())[:show]
        out["only_oracle"] = list((cd - cs).elements())[:show]
    out["ok"] = out["columns_match"] and out["values_match"]
    return out
