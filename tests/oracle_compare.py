"""Run each registered query in Spark and its oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from promptwatt.session import TABLES, get_session  # noqa: E402
from promptwatt.plans import registry  # noqa: E402,F401
import __spark_entry__ as E  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if v is None:
        return None
    return v


def rows_of(df_pd):
    cols = sorted(df_pd.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in df_pd.to_dict("records")]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        sdf = fn(spark, sf).toPandas()
        t1 = time.time()
        if name not in sqls:
            print(f"{name:34s} rows={len(sdf):7d} spark={t1 - t0:6.2f}s (no oracle)")
            continue
        ddf = con.execute(sqls[name]).df()
        t2 = time.time()
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        ok = sc == dc and sr == dr
        status = "OK " if ok else "BAD"
        print(f"{status} {name:30s} rows={len(sr):7d}/{len(dr):7d} spark={t1 - t0:6.2f}s duck={t2 - t1:6.2f}s")
        if not ok:
            bad += 1
            if sc != dc:
                print("   cols spark-only", set(sc) - set(dc), "duck-only", set(dc) - set(sc))
            else:
                diffs = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
                for a, b in diffs:
                    for c, x, y in zip(sc, a, b):
                        if x != y:
                            print(f"   {c}: spark={x!r} duck={y!r}")
                    print("   --")
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
