"""Print the physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] query [query ...] [--mode formatted|simple|cost]

Shows what Catalyst chose: pushed filters and pruned read schemas at the
scans, broadcast vs shuffle joins, partial aggregates / window limits before
exchanges, and the whole-stage codegen spans.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    mode = "formatted"
    if "--mode" in args:
        i = args.index("--mode")
        mode = args[i + 1]
        del args[i : i + 2]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from syncforge.plans import QUERIES
    from syncforge.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in args or sorted(QUERIES):
        print(f"===== {name} =====")
        QUERIES[name](spark, sf_dir).explain(mode)
    spark.stop()


if __name__ == "__main__":
    main()
