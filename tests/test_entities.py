"""Entity transforms on the synthetic edge-case snapshots."""

from __future__ import annotations

import datetime as dt

import pytest

from fixtures import write_days
from syncforge import schemas as S
from syncforge.plans.entities import agent_roles, agents, budgets, cards, groups, roles, transactions
from syncforge.sources.readers import read
from syncforge.sources.snapshots import read_day

TS = dt.datetime(2024, 5, 1, 23, 0)


@pytest.fixture(scope="module")
def snap(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("snap"))
    write_days(base)
    return base


def _day(spark, snap, name):
    df, ok = read_day(spark, snap, "day1", name)
    assert ok
    return df


def test_agents_status_and_quarantine(spark, snap):
    valid, errors = agents.transform(_day(spark, snap, "agent_details"), _day(spark, snap, "agents"), "day1", TS)
    rows = {r.agent_id: r for r in valid.collect()}
    assert sorted(rows) == list(range(1, 10))  # text id "3" parsed, 10 quarantined
    assert all(r.status == "active" for r in rows.values())
    assert rows[4].available is True  # "true" text
    assert rows[8].name == "12345"  # number in a text field
    assert rows[9].email == "a9@example.org"  # flat contact fields
    errs = errors.collect()
    assert [(e.record_key, e.error_type) for e in errs] == [("10", agents.ERROR_TYPE)]
    assert '"id":"10"' in errs[0].raw_record


def test_agents_inactive_when_missing_from_active_list(spark, snap):
    det = _day(spark, snap, "agent_details")
    act, _ = read_day(spark, snap, "day2", "agents")
    valid, _ = agents.transform(det, act, "day2", TS)
    status = {r.agent_id: r.status for r in valid.collect()}
    assert {k for k, v in status.items() if v == "active"} == {1, 2, 3, 4, 5}
    assert status[9] == "inactive"


def test_roles_flat_nested_dedup(spark, snap):
    valid, errors = roles.transform(_day(spark, snap, "roles"), "day1", TS)
    rows = {r.role_id: r for r in valid.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[2].name == "agent" and rows[2].is_default is False  # nested role.*
    assert rows[3].name == "viewer-new"  # latest of the duplicate id
    assert rows[1].agent_type == "1" and rows[5].agent_type == "7"
    assert errors.count() == 1


def test_agent_roles_unknown_and_bad_list(spark, snap):
    det = _day(spark, snap, "agent_details")
    master, _ = roles.transform(_day(spark, snap, "roles"), "day1", TS)
    pairs, errors, _ = agent_roles.transform(det, master, "day1", TS)
    got = {(r.agent_id, r.role_id) for r in pairs.collect()}
    assert (6, 42) not in got and (5, 3) in got and (10, 1) in got
    assert not any(a == 7 for a, _ in got)  # "1,2" is not a list
    assert {(e.record_key, e.error_type) for e in errors.collect()} == {
        ("42", "INVALID_ROLE_ID"),
        ("7", "INVALID_ROLE_IDS"),
    }


def test_groups_members_and_errors(spark, snap):
    valid_agents, _ = agents.transform(_day(spark, snap, "agent_details"), _day(spark, snap, "agents"), "day1", TS)
    g, members, snapshot_groups, errors = groups.transform(_day(spark, snap, "groups"), valid_agents, "day1", TS)
    # the group whose list is no list says nothing about its members
    assert g.count() == 10 and snapshot_groups.count() == 9
    assert {(r.group_id, r.agent_id) for r in members.collect()} == {(101, 6), (102, 1), (103, 2), (104, 3), (106, 8)}
    kinds = sorted((e.entity, e.error_type) for e in errors.collect())
    assert kinds == [
        ("group_membership", "INVALID_AGENT_ID"),
        ("group_membership", "INVALID_AGENT_ID"),
        ("group_membership", "INVALID_AGENT_IDS"),
        ("groups", "MISSING_GROUP_ID"),
    ]


def test_budgets_rules_and_parsing(spark, snap):
    valid, errors = budgets.transform(_day(spark, snap, "budgets"), "day1", TS)
    rows = {r.budget_id: r for r in valid.collect()}
    assert len(rows) == 11  # 14 records, 2 quarantined, one duplicate id
    assert rows["b10"].limit_amount == 250.5 and rows["b11"].limit_amount == -20.0
    assert rows["b2"].start_date == dt.date(2024, 5, 15)
    assert sorted(str(e.record_key) for e in errors.collect()) == ["None", "b12"]


def _read_json(spark, root, name, docs, schema):
    import json
    import os

    os.makedirs(f"{root}/{name}", exist_ok=True)
    for i, d in enumerate(docs):
        with open(f"{root}/{name}/{i}.json", "w") as f:
            json.dump(d, f)
    return read(spark, f"{root}/{name}", "json", schema)


def test_budgets_envelope_empty_or_null(spark, tmp_root):
    raw = _read_json(spark, tmp_root, "b", [{"results": []}, {"results": None}], S.wrapped(S.BUDGET_RECORD, "budget"))
    valid, errors = budgets.transform(raw, "d", TS)
    assert valid.count() == 0 and errors.count() == 0


def test_budgets_wrapped_row(spark, tmp_root):
    doc = {"budget": {"id": "w1", "currentPeriod": {"limit": "7"}}}
    raw = _read_json(spark, tmp_root, "w", [doc], S.wrapped(S.BUDGET_RECORD, "budget"))
    valid, _ = budgets.transform(raw, "d", TS)
    assert [(r.budget_id, r.limit_amount) for r in valid.collect()] == [("w1", 7.0)]


def test_cards_flat_records(spark, tmp_root):
    doc = [{"id": "f1", "status": "active", "type": "virtual", "createdTime": "2024-01-01T00:00:00Z",
            "currentPeriod": {"limit": 5, "spent": 1}}]
    raw = _read_json(spark, tmp_root, "c", [doc], S.envelope(S.CARD_RECORD))
    valid, errors = cards.transform(raw, "d", TS)
    assert [(r.card_id, r.current_limit, r.current_spent) for r in valid.collect()] == [("f1", 5.0, 1.0)]


def test_cards_rules(spark, snap):
    valid, errors = cards.transform(_day(spark, snap, "cards"), "day1", TS)
    rows = {r.card_id: r for r in valid.collect()}
    assert len(rows) == 13 and errors.count() == 3
    assert rows["c16"].current_limit is None  # NULL amounts are valid
    assert rows["c1"].recurring is True  # text boolean
    assert {e.record_key for e in errors.collect()} == {"c13", "c14", "c15"}


def test_transactions_fx_rules_dedup(spark, snap):
    fx = read(spark, f"{snap}/fx_rates", "csv", S.FX_RATES_DDL)
    valid, errors = transactions.transform(_day(spark, snap, "transactions"), fx, "day1", TS)
    rows = {r.transaction_id: r for r in valid.collect()}
    assert sorted(rows) == ["t1", "t10", "t12", "t13", "t2", "t3", "t5"]  # t1 twice -> once
    assert rows["t1"].fx_source == "API" and rows["t1"].amount_usd == pytest.approx(12.5)
    assert rows["t2"].exchange_rate == 1.0
    assert rows["t3"].fx_source == "PAYLOAD" and rows["t3"].amount_usd == pytest.approx(12.5)
    assert rows["t10"].amount_usd == pytest.approx(-6.25)  # refunds are valid
    assert rows["t12"].original_amount == 10.0  # flat currency fields
    msgs = {e.record_key: e.error_message for e in errors.collect()}
    assert msgs == {
        "t4": transactions.MSG_RATE,
        "t6": transactions.MSG_AMOUNT,
        "t7": transactions.MSG_CURRENCY,
        "t8": transactions.MSG_EMPTY_AMOUNT,
        "t9": transactions.MSG_AMOUNT,
        "t11": transactions.MSG_OCCURRED,
        "t14": transactions.MSG_UUID,
    }
    assert len(rows["t1"].idempotency_key) == 64
