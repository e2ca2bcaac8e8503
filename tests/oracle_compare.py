"""Order-insensitive result comparison shared by the tests and tools."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.01")))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, con, sql):
    scols, srows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    return {
        "ok": sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd,
        "cols": (sorted(scols), sorted(dcols)),
        "rows": (len(srows), len(drows)),
        "spark_only": sorted(set(ls) - set(ld))[:3],
        "oracle_only": sorted(set(ld) - set(ls))[:3],
    }
