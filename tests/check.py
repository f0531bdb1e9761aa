"""Runs registered queries against their SQL twins: python tests/check.py [folder] [name ...]"""

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import connect, difference  # noqa: E402

from statflow.catalog import ORACLES, QUERIES  # noqa: E402
from statflow.session import local_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2:]
spark = local_session(8)
spark.sparkContext.setLogLevel("OFF")
con = connect(folder)
bad = []
for name, run in QUERIES.items():
    if wanted and not any(name.startswith(w) for w in wanted):
        continue
    start = time.time()
    try:
        df = run(spark, folder)
        problem = difference(df, con, ORACLES[name]) if name in ORACLES else None
        n = "" if name in ORACLES else f"rows-only {df.count()}"
    except Exception:
        problem, n = traceback.format_exc()[-1000:], ""
    print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {n}", flush=True)
    if problem:
        bad.append(name)
        print(problem, flush=True)
print("failed:", bad)
spark.stop()
