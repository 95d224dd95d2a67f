"""Run llm queries against their DuckDB SQL: ``python tests/llm/harness.py [name ...] [--sf DIR]``."""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tests.oracle_harness import duck_con, rows_of_duck, rows_of_spark  # noqa: E402


def matches(spark, name: str, sf_dir: str, con=None, verbose: bool = False) -> bool:
    from tidepool.llm.queries import ORACLES, QUERIES
    began = time.time()
    cols, rows = rows_of_spark(QUERIES[name](spark, sf_dir))
    took = time.time() - began
    if name not in ORACLES:
        if verbose:
            print(f"{name}: {len(rows)} rows, no SQL, {took:.1f}s", rows[:3])
        return len(rows) > 0
    want_cols, want = rows_of_duck(con or duck_con(sf_dir), ORACLES[name])
    ok = cols == want_cols and Counter(rows) == Counter(want)
    if verbose:
        print(f"{name}: {'ok' if ok else 'BAD'} {len(rows)} {len(want)} rows, {took:.1f}s")
        if not ok:
            print(cols, want_cols, sep="\n")
            print(list((Counter(rows) - Counter(want)).elements())[:4])
            print(list((Counter(want) - Counter(rows)).elements())[:4])
    return ok


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    from tidepool.llm.queries import QUERIES
    from tidepool.session import get_spark
    spark = get_spark()
    con = duck_con(args.sf)
    for name in args.names or list(QUERIES):
        matches(spark, name, args.sf, con, verbose=True)


if __name__ == "__main__":
    main()
