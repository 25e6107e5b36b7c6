"""Run registered queries against their SQL: ``python tests/check_all.py [dir] [name part]``."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import connect, differences  # noqa: E402

import __spark_entry__ as e  # noqa: E402
from tablewright.session import local_session  # noqa: E402


def main(sf_dir="/root/testdata/sf0.01", part=""):
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(sf_dir), e.queries(), e.oracle_sql()
    failed = 0
    for key in sorted(k for k in queries if part in k):
        start = time.time()
        try:
            bad = differences(queries[key](spark, sf_dir), con, sql[key])
        except Exception as x:
            bad = [str(x)[:600]]
            if part:
                traceback.print_exc()
        failed += bool(bad)
        print(f"{'FAIL' if bad else 'ok  '} {key} {time.time() - start:.1f}s", *bad, sep="\n     " if bad else " ", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(*sys.argv[1:])
