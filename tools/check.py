"""Run registered queries against their oracle SQL: `python tools/check.py [sf_dir] [name ...]`.

With NO_ORACLE=1 the queries are only run and timed.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortloom.plans import ORACLES, QUERIES  # noqa: E402
from tests.compare import duck, differences, local_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    spark, con, bad = local_session(), duck(sf_dir), []
    for name in names:
        t0 = time.time()
        try:
            got = QUERIES[name](spark, sf_dir)
            rows = [tuple(r) for r in got.collect()]
            t1 = time.time()
            checked = name in ORACLES and not os.environ.get("NO_ORACLE")
            problem = differences(got.columns, rows, con, ORACLES[name]) if checked else None
            note = problem or (f"ok {len(rows)} rows" if checked else f"ran {len(rows)} rows")
        except Exception as e:  # noqa: BLE001
            t1 = time.time()
            problem = note = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        if problem:
            bad.append(name)
        print(f"{name:28s} spark {t1 - t0:6.2f}s oracle {time.time() - t1:6.2f}s  {note}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} good; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
