"""Run every registered query against its DuckDB oracle and print a report.

    python tests/run_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from folio.session import build_session  # noqa: E402
from oracle import compare  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            if name in sqls:
                res = compare(spark, sf_dir, qs[name], sqls[name])
                ok = res["columns_match"] and res["values_match"] and res["rows_spark"] == res["rows_oracle"]
            else:
                n = qs[name](spark, sf_dir).count()
                res = {"rows_spark": n, "oracle": "none"}
                ok = True
        except Exception as exc:  # report and continue
            res, ok = {"error": f"{type(exc).__name__}: {str(exc)[:800]}"}, False
        bad += not ok
        res["sec"] = round(time.time() - t0, 2)
        print(("OK  " if ok else "BAD ") + name, json.dumps(res, default=str), flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
