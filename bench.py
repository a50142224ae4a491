"""Benchmark: run the headline queries on the bench tables, print one JSON line.

These are all registered core queries, but of the day flows only those of
transactions and groups: the others run a part of the same steps.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list), BENCH_WARMUP (default 1). Each query
is executed in full with the ``noop`` sink (all rows computed, nothing
collected to the driver). With warm-up on, every query first runs once,
untimed, on the smallest tables next to the bench folder (sf0.001) so the
timings measure steady-state query cost, not JVM JIT / codegen start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


NOT_TIMED = ("flow_two_days_agents", "flow_two_days_roles", "flow_two_days_agent_roles", "flow_two_days_budgets", "flow_two_days_cards", "flow_metrics")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from syncforge.plans import QUERIES as EVERY
    from syncforge.session import build_session

    QUERIES = {n: q for n, q in EVERY.items() if n not in NOT_TIMED or n in only}
    extra = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g"),
    }
    spark = build_session("syncforge-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="syncforge-ckpt-"))  # one machine; a cluster names its own

    # warm-up: JVM JIT and codegen caches, on the smallest tables (untimed)
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name, fn in QUERIES.items():
            if not only or name in only:
                fn(spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # report, keep benchmarking the rest
            errors[name] = repr(e)[:300]
            print(f"{name}: FAILED {errors[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else None,
                "cpus": cpus,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
