"""Local stand-in for the driver's correctness gate.

Runs a registered query on Spark and its oracle SQL on DuckDB over the same
parquet tables, then compares row count, column names and an
order-insensitive multiset of normalised rows.

    python tests/oracle_harness.py [key ...] [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tidepool.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return tuple((k, _norm(x)) for k, x in v.asDict().items())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def duck_con(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def compare(spark, key, sf_dir, con=None, verbose=True):
    from tidepool.plans import registry_dicts
    fns, oracles = registry_dicts()
    con = con or duck_con(sf_dir)
    t0 = time.time()
    scols, srows = rows_of_spark(fns[key](spark, sf_dir))
    t1 = time.time()
    if key not in oracles:
        if verbose:
            print(f"{key}: rows-only {len(srows)} rows ({t1 - t0:.1f}s)")
        return True
    dcols, drows = rows_of_duck(con, oracles[key])
    ok = scols == dcols and Counter(srows) == Counter(drows)
    if verbose:
        status = "OK " if ok else "BAD"
        print(f"{status} {key}: spark {len(srows)} rows, oracle {len(drows)} rows ({t1 - t0:.1f}s)")
        if not ok:
            if scols != dcols:
                print("   spark cols ", scols)
                print("   oracle cols", dcols)
            else:
                cs, cd = Counter(srows), Counter(drows)
                print("   only spark :", list((cs - cd).elements())[:4])
                print("   only oracle:", list((cd - cs).elements())[:4])
    return ok


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("keys", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    from tidepool.plans import registry_dicts
    from tidepool.session import get_spark
    spark = get_spark()
    fns, _ = registry_dicts()
    keys = args.keys or list(fns)
    con = duck_con(args.sf)
    bad = []
    for k in keys:
        try:
            if not compare(spark, k, args.sf, con):
                bad.append(k)
        except Exception as e:  # report and continue
            print(f"ERR {k}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(k)
    print(f"{len(keys) - len(bad)}/{len(keys)} passed; failing: {bad}")


if __name__ == "__main__":
    main()
