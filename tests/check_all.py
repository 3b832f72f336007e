"""Run every registered query against its oracle (CLI helper).

usage: python tests/check_all.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from shroud.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8, int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")),
                          checkpoint_dir=tempfile.mkdtemp(prefix="shroud-check-"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t = time.time()
        if name not in sqls:
            try:
                n = qs[name](spark, sf).count()
                print(f"{name:28s} rows-only {n} ({time.time()-t:.1f}s)")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"{name:28s} ERROR {str(e)[:600]}")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {str(e)[:400]}")
            continue
        ok = r["cols_match"] and r["hash_match"] and r["rows"][0] == r["rows"][1] and not r["type_diff"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={r['rows']} ({time.time()-t:.1f}s)")
        if not ok:
            for key in ("type_diff", "spark_cols", "duck_cols", "only_spark", "only_duck"):
                print("    ", key, r.get(key))
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
