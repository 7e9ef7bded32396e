"""Compare a Spark workload with its DuckDB oracle (order-insensitive).

Usage: python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, acols = rows_of(sdf.columns, srows)
    b, bcols = rows_of(dcols, drows)
    ok = acols == bcols and Counter(a) == Counter(b)
    detail = ""
    if not ok:
        if acols != bcols:
            detail = f"cols spark={acols} oracle={bcols}"
        else:
            ca, cb = Counter(a), Counter(b)
            detail = (f"rows spark={len(a)} oracle={len(b)}; only spark: {list((ca - cb).elements())[:3]}; "
                      f"only oracle: {list((cb - ca).elements())[:3]}")
    return ok, len(a), len(b), t1 - t0, detail


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from ingestkit.session import local_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    if os.environ.get("ORACLE_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in os_:
            df = qs[name](spark, sf_dir)
            print(f"ROWS-ONLY {name}: {df.count()} rows")
            continue
        ok, na, nb, secs, detail = compare(spark, con, name, qs[name], os_[name], sf_dir)
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: spark={na} oracle={nb} {secs:.1f}s {detail}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
