"""Check registered queries by hand: python -m tests.check [sf] [name-prefix ...]"""

import sys
import traceback

from tests.compare import connect, difference
from threadline.session import build_session

if __name__ == "__main__":
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", 8)
    con = connect(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or name.startswith(w + "_") or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            problem, rows, seconds = difference(spark, folder, fn, oracles.get(name), con)
        except Exception as error:
            problem, rows, seconds = "ERROR " + str(error)[:1500], -1, 0
            if len(wanted) == 1:
                traceback.print_exc()
        bad += problem is not None
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5s}{name:34s}{rows:8d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
