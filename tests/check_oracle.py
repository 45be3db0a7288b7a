"""Run registered queries against their oracle: python tests/check_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

from strata.session import build_session  # noqa: E402


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in oracle:
                ok, msg = compare(df, con, oracle[name])
            else:
                ok, msg = True, f"no oracle, {df.count()} rows"
        except Exception as exc:  # report and continue
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:40s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
