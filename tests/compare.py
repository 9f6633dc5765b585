"""Run registered queries against their SQL: ``python tests/compare.py [folder] [name ...]``."""

import logging
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402
from tillwork.session import local_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8, "compare")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = differences(fn(spark, folder), con, oracle[name])
                note = "sql"
            else:
                rows = fn(spark, folder).collect()
                problem, note = None, f"rows={len(rows)} {rows[:2] if wanted else ''}"
        except Exception:
            problem, note = traceback.format_exc()[-1500:], "error"
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {note}", flush=True)
        if problem:
            failed.append(name)
            print(problem[:1800], flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
