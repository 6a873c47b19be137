"""Run every registered query against its DuckDB oracle and print a report.

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck, explain_mismatch, type_families  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session(driver_memory="8g")
    q, o = entry.queries(), entry.oracle_sql()
    report = {}
    for name in names or sorted(q):
        t0 = time.time()
        try:
            if name not in o:
                n = q[name](spark, sf).count()
                report[name] = {"status": "rows-only", "rows": n}
                print(f"{name:28s} rows-only {n}", flush=True)
                continue
            built = q[name](spark, sf)
            s, d, sf_full, d_full = compare(spark, sf, lambda *_: built, o[name])
            ok = s == d
            fam = type_families(built.schema, duck(sf).sql(o[name]))
            if fam:
                print(f"   type families differ: {fam}")
            report[name] = {"status": "match" if ok else "MISMATCH", "spark": s[:2], "duck": d[:2]}
            print(f"{name:28s} {'match' if ok else 'MISMATCH'} rows={s[0]}/{d[0]} {time.time()-t0:.1f}s",
                  flush=True)
            if not ok:
                if s[1] != d[1]:
                    print("   cols spark:", s[1], "\n   cols duck: ", d[1])
                cols, only_s, only_d = explain_mismatch(sf_full, d_full)
                print("   cols:", cols)
                for r in only_s:
                    print("   spark-only:", r[:400])
                for r in only_d:
                    print("   duck-only: ", r[:400])
        except Exception as exc:  # noqa: BLE001
            report[name] = {"status": "ERROR", "error": str(exc)[:500]}
            print(f"{name:28s} ERROR {exc!s:.600}")
            traceback.print_exc(limit=3)
    print(json.dumps({k: v["status"] for k, v in report.items()}))


if __name__ == "__main__":
    main()
