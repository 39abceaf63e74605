"""Run registered queries against their DuckDB oracles (the driver's gate).

usage: python scripts/check_oracles.py [sf_dir] [name ...]
"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inkwell.plans.compare import compare, duckdb_connection  # noqa: E402
from inkwell.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from inkwell.session import build_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    load_all()
    names = sys.argv[2:] or sorted(QUERIES)
    spark = build_session()
    con = duckdb_connection(sf)
    bad = 0
    for n in names:
        t = time.time()
        try:
            df = QUERIES[n](spark, sf)
            if n in ORACLES:
                r = compare(df, con, ORACLES[n])
                ok = r["hash_match"] and r["rows_spark"] == r["rows_oracle"]
            else:
                r = {"rows_spark": df.count(), "oracle": None}
                ok = True
        except Exception as e:  # report and continue
            r, ok = {"error": str(e)[:600]}, False
        bad += not ok
        print(("OK  " if ok else "BAD ") + n, round(time.time() - t, 1), json.dumps(r, ensure_ascii=False, default=str), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
