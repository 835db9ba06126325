"""Run queries against their check SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import difference, duck  # noqa: E402

from souk.registry.oracle import ORACLE  # noqa: E402
from souk.registry.queries import QUERIES  # noqa: E402
from souk.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            found = difference(con, QUERIES[name](spark, sf_dir), ORACLE[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
