"""python tests/compare.py SF_DIR [NAME...]: each query against its SQL, as rows."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(base: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(base)):
        p = os.path.join(base, f)
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    return round(v, 9) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differ(spark, con, base: str, query, sql: str):
    """None when equal, else a short account."""
    df = query(spark, base)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        return f"{sum(got.values())} and {sum(want.values())} rows; only Spark: {list((got - want).items())[:3]}; only SQL: {list((want - got).items())[:3]}"
    return None


if __name__ == "__main__":
    from lexspark.session import local_session

    import __spark_entry__ as e

    base, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(base)
    bad = 0
    for n, q in e.queries().items():
        if names and n not in names or n not in e.oracle_sql():
            continue
        t = time.time()
        try:
            why = differ(spark, con, base, q, e.oracle_sql()[n])
        except Exception as x:  # noqa: BLE001
            why = f"{type(x).__name__}: {str(x)[:1500]}"
        bad += bool(why)
        print(f"{n}: {'ok' if not why else 'DIFFERENT ' + why} {time.time() - t:.1f} s", flush=True)
    sys.exit(bool(bad))
