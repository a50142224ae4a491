"""Bad input is quarantined and never changes good rows; a day can be run again with other input."""

from __future__ import annotations

import json
import os

from syncforge import schemas as S
from syncforge.operators.assignments import empty_mapping, merge_assignments
from syncforge.operators.fx import rates_to_usd
from syncforge.operators.membership import replace_members
from syncforge.operators.merge import merge_latest
from syncforge.operators.refer import deactivate_absent
from syncforge.plans.entities import agent_roles, cards, groups
from syncforge.sinks.tables import TableStore
from syncforge.sources.snapshots import read_day

TS = "2024-05-01 00:00:00"


def _json(spark, folder, rows, schema):
    path = os.path.join(folder, "in.json")
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    return spark.read.schema(schema).json(path)


def test_unreadable_member_list_keeps_members(spark, tmp_root):
    raw = _json(
        spark,
        tmp_root,
        [{"id": 10, "name": "a", "agent_ids": "1,2"}, {"id": 11, "name": "b", "agent_ids": [1, "abc", None, 2]}, {"id": 12, "name": "c", "agent_ids": []}],
        "id string, name string, parent_group_id string, created_at string, updated_at string, agent_ids string",
    )
    agents = spark.createDataFrame([(1,), (2,)], "agent_id bigint")
    _, members, listed, errors = groups.transform(raw, agents, "day2", None)
    stored = spark.createDataFrame([(10, 1), (10, 2), (11, 9), (12, 1)], "group_id bigint, agent_id bigint")
    now = replace_members(stored, members, listed)
    assert sorted((r.group_id, r.agent_id) for r in now.collect()) == [(10, 1), (10, 2), (11, 1), (11, 2)]
    kinds = sorted((r.record_key, r.error_message) for r in errors.collect())
    assert kinds == [("10", groups.BAD_LIST[1]), ("11", groups.BAD_ELEMENT[1])]


def test_unreadable_role_list_keeps_pairs_and_latest_detail_counts(spark, tmp_root):
    schema = "id string, role_ids string, updated_at string"
    roles = spark.createDataFrame([(7,), (8,)], "role_id bigint")
    rows = [
        {"id": 1, "role_ids": "7,8"},
        {"id": 2, "role_ids": [7], "updated_at": "2024-01-01T00:00:00"},
        {"id": 2, "role_ids": [8, "x"], "updated_at": "2024-02-01T00:00:00"},
    ]
    pairs, errors, unread = agent_roles.transform(_json(spark, tmp_root, rows, schema), roles, "day2", None)
    assert [(r.agent_id, r.role_id) for r in pairs.collect()] == [(2, 8)]
    stored = merge_assignments(empty_mapping(spark), spark.createDataFrame([(1, 7), (2, 7)], "agent_id bigint, role_id bigint"), TS).drop("_action")
    now = {(r.agent_id, r.role_id): r.status for r in merge_assignments(stored, pairs, TS, untouched=unread).collect()}
    assert now == {(1, 7): "assigned", (2, 7): "removed", (2, 8): "assigned"}
    assert sorted(r.error_message for r in errors.collect()) == sorted([agent_roles.BAD_LIST[1], agent_roles.BAD_ELEMENT[1]])


def test_quarantined_agent_is_not_absent(spark):
    core = spark.createDataFrame([(1, "active"), (2, "active"), (3, "active")], "agent_id bigint, status string")
    staged = spark.createDataFrame([(1, "active")], "agent_id bigint, status string")
    seen = spark.createDataFrame([(1,), (2,), (2,)], "agent_id bigint")
    out = deactivate_absent(merge_latest(core, staged, ["agent_id"]), present=seen)
    assert {r.agent_id: r.status for r in out.collect()} == {1: "active", 2: "active", 3: "inactive"}


def test_card_numbers_that_do_not_parse(spark, tmp_root):
    card = {"id": "c1", "status": "ACTIVE", "type": "CARD", "createdTime": "2024-01-01T00:00:00"}
    rows = [card, card | {"id": "c2", "currentPeriod": {"limit": "abc"}}, card | {"id": "c3", "updatedTime": "soon"}, card | {"id": "c4", "recurringLimit": " "}]
    rows += [card | {"id": "c5", "updatedTime": f"2024-01-0{d}T00:00:00", "name": f"n{d}"} for d in (1, 3, 2)]
    raw = _json(spark, tmp_root, [{"results": [r]} for r in rows], S.CARDS_READ if hasattr(S, "CARDS_READ") else _card_schema())
    valid, errors = cards.transform(raw, "day1", None)
    assert sorted((r.card_id, r.name) for r in valid.collect()) == [("c1", None), ("c4", None), ("c5", "n3")]
    assert sorted(r.record_key for r in errors.collect()) == ["c2", "c3"]


def _card_schema():
    return (
        "results array<struct<id string, uuid string, name string, userId string, userUuid string, budgetId string, budgetUuid string, lastFour string, "
        "validThru string, status string, type string, shareBudgetFunds string, recurring string, recurringLimit string, "
        "currentPeriod struct<limit string, spent string>, createdTime string, updatedTime string>>"
    )


def test_folder_is_replaced_by_an_empty_frame(spark, tmp_root):
    store = TableStore(spark, tmp_root)
    rows = spark.createDataFrame([(1, "a")], "k bigint, v string")
    assert store.overwrite_folder("stg", rows, stg_day="day1").count() == 1
    assert store.overwrite_folder("stg", rows, stg_day="day2").count() == 1
    assert store.overwrite_folder("stg", rows.where("false"), stg_day="day1").count() == 0
    assert [r.stg_day for r in store.read_partitioned("stg", "k bigint").collect()] == ["day2"]
    assert store.overwrite_folder("never", rows.where("false"), stg_day="day1").collect() == []


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest

    from syncforge.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_unreadable_documents_are_quarantined_with_their_text(spark, tmp_root):
    folder = os.path.join(tmp_root, "sync-1", "cards")
    os.makedirs(folder)
    card = {"id": "c1", "status": "active", "type": "virtual", "createdTime": "2024-01-01T00:00:00"}
    texts = {
        "good.json": json.dumps({"results": [card, {**card, "id": "c2"}]}),
        "flat.json": json.dumps({**card, "id": "c3"}),
        "cut.json": json.dumps({"results": [card]})[:-20],
        "object.json": json.dumps({"results": card}),
        "empty.json": json.dumps({"results": []}),
    }
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    raw, _ = read_day(spark, tmp_root, "1", "cards")
    valid, errors = cards.transform(raw, "1", None)
    assert sorted(r.card_id for r in valid.collect()) == ["c1", "c2", "c3"]
    kept = [json.loads(r.raw_record)["_corrupt_record"] for r in errors.collect()]
    assert sorted(kept) == sorted([texts["cut.json"], texts["object.json"]])


def test_quotes_that_differ_are_no_rate(spark):
    rates = spark.createDataFrame(
        [("2024-01-01", "EUR", 0.5), ("2024-01-01", "EUR", 0.8), ("2024-01-02", "EUR", 0.5), ("2024-01-02", "eur", 0.5), ("2024-01-03", "EUR", 0.0)],
        "fx_date string, currency string, usd_quote double",
    )
    got = {str(r["_fx_date"]): r["_api_rate"] for r in rates_to_usd(rates).collect()}
    assert got == {"2024-01-01": None, "2024-01-02": 2.0, "2024-01-03": None}


def test_corrupt_active_list_deactivates_nobody(spark, tmp_root):
    """A-07: what the list still says counts, and nobody becomes inactive by what it lost."""
    from fixtures import write_days
    from syncforge.plans.flow import QUARANTINE, run_day

    base = f"{tmp_root}/snap"
    days = write_days(base)
    store = TableStore(spark, f"{tmp_root}/t")
    run_day(spark, base, days[0], store, only=["agents"])
    before = {r.agent_id: r.status for r in store.read("agents", S.AGENTS_DDL).collect()}
    folder = f"{base}/sync-{days[1]}/agents"
    for name in os.listdir(folder):
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write('[{"id": 1}, {"id": 2')
    run_day(spark, base, days[1], store, only=["agents"])
    assert {r.agent_id: r.status for r in store.read("agents", S.AGENTS_DDL).collect()} == before
    bad = store.read_partitioned(QUARANTINE, S.QUARANTINE_DDL).where("error_type = 'UNREADABLE_ACTIVE_LIST'").collect()
    assert len(bad) == 1 and bad[0].raw_record.startswith('[{"id": 1}')


def test_hot_day_and_currency_is_not_shuffled(spark):
    """All rows on one (day, currency): the rate comes from a broadcast day, beyond the bound from salted ones."""
    from syncforge.operators import fx

    rows = spark.range(2000).selectExpr("id", "IF(id < 0, DATE'2024-05-02', DATE'2024-05-01') AS fx_date", "IF(id = 7, 'USD', 'EUR') AS original_currency", "CAST(id AS DECIMAL(38,9)) AS original_amount", "CAST(NULL AS DOUBLE) AS payload_exchange_rate")
    kind = "fx_date date, currency string, usd_quote double"
    import datetime as dt

    rates = spark.createDataFrame([(dt.date(2024, 5, 1), "eur", 2.0), (dt.date(2024, 5, 1), "JPY", 0.0), (dt.date(2024, 5, 2), "EUR", 4.0)], kind)
    out = fx.convert_to_usd(rows, rates)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan, plan
    want = {i: (i, "API") if i == 7 else (i / 2, "API") for i in range(2000)}
    assert {r.id: (float(r.amount_usd), r.fx_source) for r in out.collect()} == want
    bound = fx.BROADCAST_DAYS
    fx.BROADCAST_DAYS = 1
    try:
        salted = fx.convert_to_usd(rows, rates)
        assert {r.id: (float(r.amount_usd), r.fx_source) for r in salted.collect()} == want
    finally:
        fx.BROADCAST_DAYS = bound
