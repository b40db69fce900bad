"""Command line: compare registered queries with their SQL and print times.

    python tests/check_queries.py /root/testdata/sf0.01 [name ...]
"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import connect, difference  # noqa: E402

from reelpress.plans.catalog import CATALOG  # noqa: E402
from reelpress.session import build_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "check",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
         "spark.driver.memory": "12g"},
        master="local[8]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or CATALOG:
        query, start = CATALOG[name], time.time()
        try:
            df = query.run(spark, folder)
            problem = difference(df, con, query.sql) if query.sql else None
            note = "" if query.sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on
            problem, note = "".join(traceback.format_exception_only(error))[:1500], ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {note}"
              f"{problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
