"""Run each registered query and its DuckDB SQL on the same tables and compare
row count, column names and an order-insensitive multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", repr(e)[:400])
            if verbose:
                print(name, "SPARK ERROR", repr(e)[:400], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(rows))
            if verbose:
                print(f"{name}: rows-only {len(rows)} ({ts:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("sql-error", repr(e)[:400])
            if verbose:
                print(name, "SQL ERROR", repr(e)[:400], flush=True)
            continue
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
        a = Counter(tuple(_norm(r[i]) for i in order) for r in rows)
        b = Counter(tuple(_norm(r[i]) for i in oorder) for r in orows)
        ok = sorted(cols) == sorted(ocols) and a == b
        results[name] = ("ok" if ok else "mismatch", len(rows), len(orows))
        if verbose:
            print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(rows)} duck={len(orows)} ({ts:.1f}s)", flush=True)
            if not ok:
                if sorted(cols) != sorted(ocols):
                    print("   cols", sorted(cols), sorted(ocols))
                else:
                    print("   spark-only", list((a - b).items())[:3])
                    print("   duck-only ", list((b - a).items())[:3])
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tableload.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    print("SUMMARY", len(res), "queries,", len(bad), "bad:", sorted(bad))
