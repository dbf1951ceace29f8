"""Compare every registered query with its DuckDB twin (CLI).

usage: python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import oracle_compare as oc  # noqa: E402

import __spark_entry__ as se  # noqa: E402
from wardstar.session import get_session  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session(master="local[8]", shuffle_partitions=8)
    con = oc.duck(sf)
    qs, sqls = se.queries(), se.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            a = oc.spark_digest(df)
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t
        if name not in sqls:
            print(f"{name:32s} rows-only {a[0]} rows {dt:.1f}s")
            continue
        try:
            b = oc.duck_digest(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ok = a == b
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows {a[0]}/{b[0]} {dt:.1f}s")
        if not ok:
            if a[1] != b[1]:
                print("   cols spark", a[1], "\n   cols duck ", b[1])
            else:
                x, y = oc.first_diff(df, con, sqls[name])
                print("   spark-only", x, "\n   duck-only ", y)
    print("FAILED", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
