"""Row normalisation shared by the tests (tools/compare.py --exact rules)."""

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return 0.0 if v == 0 else v  # exact: Spark and the oracle compute the same doubles
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows(df_rows, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in df_rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def spark_rows(df):
    cols = sorted(df.columns)
    return rows(df.collect(), cols)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = {c: i for i, c in enumerate(names)}
    return rows([{c: r[idx[c]] for c in names} for r in data], cols), cols
