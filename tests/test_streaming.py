from __future__ import annotations

import os

from fixtures import write_days
from syncforge import schemas as S
from syncforge.plans.flow import QUARANTINE, read_core, run_day
from syncforge.sinks.tables import TableStore
from syncforge.sources.readers import read
from syncforge.sources.snapshots import read_day
from syncforge.streaming.snapshots import apply_batch, sync_stream


def test_stream_matches_batch_and_restarts(spark, tmp_root):
    base = f"{tmp_root}/snap"
    write_days(base)
    store = TableStore(spark, f"{tmp_root}/t")
    fx = read(spark, f"{base}/fx_rates", "csv", S.FX_RATES_DDL)
    q = sync_stream(spark, base, "transactions", store, f"{tmp_root}/ck", fx_rates=fx, max_files_per_trigger=1)
    q.awaitTermination(300)
    core = {r.transaction_id: r for r in read_core(store, "transactions").collect()}
    assert sorted(core) == ["t1", "t10", "t12", "t13", "t2", "t3", "t5"]
    assert core["t1"].updated_time.day == 2  # day-2 file merged after day 1
    runs = sorted(store._names(store.path("_ledger")))
    # restart: no new files, nothing reprocessed
    q2 = sync_stream(spark, base, "transactions", store, f"{tmp_root}/ck", fx_rates=fx)
    q2.awaitTermination(300)
    assert sorted(store._names(store.path("_ledger"))) == runs


def test_days_of_one_batch_keep_their_order_and_layout(spark, tmp_root):
    """All days in one micro-batch, after a batch run of day 1: one quarantine layout, the last day's budgets win."""
    base = f"{tmp_root}/snap"
    days = write_days(base)
    store = TableStore(spark, f"{tmp_root}/t")
    run_day(spark, base, days[0], store, only=["budgets"])
    for i, day in enumerate(days):  # the order in which the files were written
        for folder, _, names in os.walk(f"{base}/sync-{day}/budgets"):
            for n in names:
                os.utime(f"{folder}/{n}", (1_700_000_000 + 1000 * i,) * 2)
    sync_stream(spark, base, "budgets", store, f"{tmp_root}/ck").awaitTermination(300)
    core = {r.budget_id: r for r in read_core(store, "budgets").collect()}
    assert core["b2"].limit_amount == 302 and core["b2"].sync_day == "day3"
    q = store.read_partitioned(QUARANTINE, S.QUARANTINE_DDL)
    assert {r.sync_day for r in q.select("sync_day").distinct().collect()} == {"day1", "stream-budgets-0"}
    m = store.read_log("pipeline_metrics", S.PIPELINE_METRICS_DDL).collect()
    assert sorted(r.day for r in m) == ["day1", "stream-budgets-0"]


def test_replayed_batch_changes_nothing(spark, tmp_root):
    base = f"{tmp_root}/snap"
    days = write_days(base)
    store = TableStore(spark, f"{tmp_root}/t")
    batch, _ = read_day(spark, base, days[0], "cards")
    assert apply_batch("cards", store, batch, 7) and not apply_batch("cards", store, batch, 7)
    assert len(store._names(store.path("_ledger"))) == 1
