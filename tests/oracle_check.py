"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, rows spark/duckdb, match flag.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if EXACT else round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir, names=None):
    import __spark_entry__ as E
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} SPARK ERROR {str(e)[:300]}")
            results[name] = False
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"{name:40s} rows={len(srows)} (no oracle) {ts:.1f}s")
            results[name] = None
            continue
        try:
            rel = con.sql(orc[name])
            dcols, dtypes = rel.columns, [str(t) for t in rel.types]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} DUCKDB ERROR {str(e)[:300]}")
            results[name] = False
            continue
        same_cols = sorted(scols) == sorted(dcols)
        stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                  for f in df.schema.fields}
        type_diff = [(c, stypes[c], t) for c, t in zip(dcols, dtypes) if c in stypes and stypes[c] != t]
        ok = same_cols and not type_diff and rows_key(srows, scols) == rows_key(drows, dcols)
        results[name] = ok
        extra = ""
        if type_diff:
            extra = f" type differences: {type_diff}"
        elif not same_cols:
            extra = f" cols spark-only={sorted(set(scols)-set(dcols))} duck-only={sorted(set(dcols)-set(scols))}"
        elif not ok:
            a, b = rows_key(srows, scols), rows_key(drows, dcols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            extra = f" first diffs: {diff}"
        print(f"{name:40s} rows={len(srows)}/{len(drows)} match={ok} {ts:.1f}s{extra}"[:1500])
    return results


if __name__ == "__main__":
    from arspark.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v is False]
    print("FAILED:", bad)
