"""Compare every registered query with its oracle: python tests/run_oracle.py [sf_dir] [names..]"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tallybook.session import get_session  # noqa: E402
from tests.oracle_compare import compare, duck_connection  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for k, fn in qs.items():
        if names and k not in names:
            continue
        if k not in sqls:
            print(json.dumps({"query": k, "oracle": "none"}))
            continue
        t = time.time()
        try:
            r = compare(spark, k, fn, sqls[k], sf_dir, con)
        except Exception as e:  # report and continue
            r = {"query": k, "error": str(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        ok = r.get("values_match") and r.get("columns_match") and r["spark_rows"] == r["oracle_rows"]
        bad += 0 if ok else 1
        print(json.dumps(r, default=str))
    print("FAILED" if bad else "ALL MATCH", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
