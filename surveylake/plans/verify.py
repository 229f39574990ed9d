"""Compare a query's Spark result with its oracle SQL run by DuckDB.

Order-insensitive; columns compared by name.  Used by the tests and by
``tools/oracle_check.py``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql) -> tuple[bool, str]:
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    sc, sr = canonical(df.columns, srows)
    oc, orr = canonical(ocols, orows)
    if sc != oc:
        return False, f"columns differ: spark={sc} oracle={oc}"
    if sr != orr:
        diff = next(((a, b) for a, b in zip(sr, orr) if a != b), None)
        return False, f"rows differ: spark={len(sr)} oracle={len(orr)} first={diff}"
    return True, f"rows={len(sr)}"
