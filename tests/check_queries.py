"""Run registered queries against their SQL: python tests/check_queries.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from martkit.catalog import ORACLE, QUERIES  # noqa: E402
from martkit.session import local_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = connect(sf)
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLE:
                diff = differences(df, con, ORACLE[name])
            else:
                diff = None if df.count() else "no rows"
        except Exception:
            diff = traceback.format_exc()[-1500:]
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t:.2f}s {'' if name in ORACLE else '(rows only)'}", flush=True)
        if diff:
            print("    ", diff[:1500], flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(bad > 0)
