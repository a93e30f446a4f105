"""Run every registered job against its DuckDB oracle and print a summary.

usage: python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from admitlab.oracle.compare import compare, duck  # noqa: E402
from admitlab.oracle.registry import oracle_sql  # noqa: E402
from admitlab.plans.registry import jobs  # noqa: E402
from admitlab.session import get_spark  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for key, job in sorted(jobs().items()):
        if only and key not in only:
            continue
        t = time.time()
        try:
            df = job(spark, sf_dir)
            if key not in sqls:
                n = df.count()
                print(f"NOSQL {key:32s} rows={n} {time.time()-t:.1f}s")
                continue
            r = compare(key, df, con, sqls[key])
            tag = "OK   " if r.ok and r.exact and r.types_ok else ("OK~  " if r.ok else "FAIL ")
            if r.ok and not r.types_ok:
                r.detail = f"types: {r.types}"
            if not r.ok:
                bad += 1
            print(f"{tag}{key:32s} rows={r.spark_rows}/{r.oracle_rows} {time.time()-t:.1f}s {r.detail}")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {key:32s} {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=2)
    missing = sorted(set(sqls) - set(jobs()))
    if missing:
        print("oracle keys without job:", missing)
    print(f"done, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
