"""Run registered queries against their SQL: python -m tests.check [name part ...]."""

import os
import sys
import time

from foliospark.queries import load
from foliospark.session import local_session
from tests.oracle import connect, differences


def main() -> int:
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    parts = sys.argv[1:]
    spark = local_session()
    con = connect(folder)
    bad = 0
    for name, q in load().items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            if q.sql is None:
                diff = [] if q.run(spark, folder).count() >= 0 else ["negative"]
            else:
                diff = differences(q.run(spark, folder), con, q.sql)
        except Exception as e:  # report and go on with the next query
            diff = [f"{type(e).__name__}: {str(e)[:1200]}"]
        mark = "ok  " if not diff else "FAIL"
        print(f"{mark} {name} {time.time() - t:.2f}s" + ("" if q.sql else " (rows only)"), flush=True)
        for line in diff:
            print("     ", line)
        bad += bool(diff)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
