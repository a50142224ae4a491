"""End-to-end day flow on snapshots generated from the driver tables.

Usage: python tools/scale_flow.py [sf_dir] [days]

Writes JSON-lines snapshots for every entity into a fresh temp folder
(customers as agents, nations as roles, parts as groups and cards,
suppliers as budgets, orders as transactions), then runs ``run_day`` for
each day and prints per-entity timings and merge counts. Day N>1 re-sends
the same records with later update times plus the next slice of orders, so
merges see inserts, updates and stale rows.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from syncforge import schemas as S  # noqa: E402
from syncforge.plans import flow  # noqa: E402
from syncforge.plans.q_entities import record as _record  # noqa: E402
from syncforge.plans.q_validate import orders_as_transactions, orders_fx_rates  # noqa: E402
from syncforge.plans.tables import table  # noqa: E402
from syncforge.session import build_session  # noqa: E402
from syncforge.sinks.tables import TableStore  # noqa: E402


def _write(df, path):
    df.write.mode("overwrite").json(path)


def generate(spark, sf_dir: str, base: str, day: int) -> None:
    root = f"{base}/sync-day{day}"
    stamp = F.lit(f"2024-05-0{day}T00:00:00")
    c = table(spark, sf_dir, "customer")
    contact = _record(S.CONTACT, {"email": F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@x.org")), "name": F.col("c_name")})
    roles = F.concat(F.lit("["), F.col("c_nationkey").cast("string"), F.lit("]"))
    details = c.select(
        _record(
            S.AGENT_DETAIL_RECORD,
            {"id": F.col("c_custkey").cast("string"), "contact": contact, "updated_at": stamp, "role_ids": roles},
        ).alias("r")
    ).select("r.*")
    _write(details, f"{root}/agent_details")
    o = table(spark, sf_dir, "orders")
    lo, hi = f"{1995 + day}-01-01", f"{1997 + day}-01-01"
    active = o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select(
        F.col("o_custkey").cast("string").alias("id")
    ).distinct()
    _write(active, f"{root}/agents")
    n = table(spark, sf_dir, "nation")
    _write(n.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), stamp.alias("updated_at")), f"{root}/roles")
    p = table(spark, sf_dir, "part")
    groups = p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.expr("CAST(p_partkey div 3 AS STRING)").alias("parent_group_id"),
        stamp.alias("updated_at"),
        F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit("]")).alias("agent_ids"),
    )
    _write(groups, f"{root}/admin_groups")
    card = _record(
        S.CARD_RECORD,
        {
            "id": F.concat(F.lit("c"), F.col("p_partkey").cast("string")),
            "status": F.lit("active"),
            "type": F.lit("virtual"),
            "currentPeriod": {"limit": F.col("p_retailprice").cast("string"), "spent": F.lit(str(day))},
            "createdTime": F.lit("2024-01-01T00:00:00"),
            "updatedTime": stamp,
        },
    )
    _write(p.select(F.array(card).alias("results")), f"{root}/cards")
    s = table(spark, sf_dir, "supplier")
    budget = _record(
        S.BUDGET_RECORD,
        {"id": F.concat(F.lit("b"), F.col("s_suppkey").cast("string")), "name": F.col("s_name"), "currentPeriod": {"limit": F.col("s_acctbal").cast("string")}},
    )
    _write(s.select(F.array(budget).alias("results")), f"{root}/budgets")
    txn = orders_as_transactions(spark, sf_dir)
    if day > 1:  # later update stamps: the guarded merge must take them
        txn = txn.withColumn("updatedTime", F.when(F.col("updatedTime").isNotNull(), F.lit(f"2030-01-0{day}T00:00:00")))
    _write(txn, f"{root}/transactions")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    days = int(sys.argv[2]) if len(sys.argv) > 2 else 2
    work = tempfile.mkdtemp(prefix="syncforge-scale-")
    spark = build_session(
        master="local[8]",
        shuffle_partitions=16,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(f"{work}/ckpt")
    base = f"{work}/snap"
    t0 = time.time()
    for d in range(1, days + 1):
        generate(spark, sf_dir, base, d)
    fx = orders_fx_rates(spark, sf_dir)
    fx.write.parquet(f"{work}/fx")
    fx = spark.read.parquet(f"{work}/fx")
    print(json.dumps({"generated_s": round(time.time() - t0, 1), "work": work}), flush=True)
    store = TableStore(spark, f"{work}/tables")
    for d in range(1, days + 1):
        ctx = flow.DayContext(spark, base, f"day{d}", store, dt.datetime(2024, 5, d, 23), f"run{d}", fx_rates=fx, multiline=False)
        ctx.day_date = dt.date(2024, 5, d)
        out = {"day": d}
        for name, fn in (
            ("agents", flow.sync_agents), ("groups", flow.sync_groups), ("roles", flow.sync_roles),
            ("agent_roles", flow.sync_agent_roles), ("budgets", flow.sync_budgets), ("cards", flow.sync_cards),
            ("transactions", flow.sync_transactions),
        ):
            t = time.time()
            fn(ctx)
            r = ctx.results.get(name, {})
            out[name] = {"s": round(time.time() - t, 2), **({k: r[k] for k in ("rows_inserted", "rows_updated", "rows_deleted")} if isinstance(r, dict) else {})}
        flow.finish(ctx)
        print(json.dumps(out), flush=True)
    inactive = flow.read_core(store, "groups", S.GROUPS_DDL).filter("inactive").count()
    print(json.dumps({"groups_inactive": inactive, "transactions": flow.read_core(store, "transactions").count()}))
    spark.stop()


if __name__ == "__main__":
    main()
