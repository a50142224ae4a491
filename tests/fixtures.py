"""Synthetic daily snapshots with the edge cases of the sample exports.

All names and values are invented. ``write_days(base)`` writes three days
in the export layout ``<base>/sync-dayN/<folder>/*.json`` plus an FX rates
CSV, and returns the day labels.
"""

from __future__ import annotations

import json
import os


def _dump(path: str, obj) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=1)


def agent_detail(i, email=True, name=True, roles=None, updated="2024-05-01T10:00:00Z", nested=True, **extra):
    contact = {"email": f"a{i}@example.org" if email else None, "name": f"Agent {i}" if name else None,
               "job_title": "analyst", "language": "en", "time_zone": "UTC",
               "last_login_at": "2024-04-30T08:00:00Z"}
    rec = {"id": i, "available": True, "created_at": "2024-01-01T00:00:00Z", "updated_at": updated,
           "role_ids": roles if roles is not None else [1, 2]}
    if nested:
        rec["contact"] = contact
    else:
        rec.update({k: v for k, v in contact.items() if k != "last_login_at"})
    rec.update(extra)
    return rec


def day_agent_details():
    out = [agent_detail(i) for i in range(1, 9)]
    out[2]["id"] = "3"  # id as text
    out[3]["available"] = "true"  # boolean as text
    out[4]["role_ids"] = [1, 3]
    out[5]["role_ids"] = [2, 42]  # role 42 unknown
    out[6]["role_ids"] = "1,2"  # not a list -> quarantined
    out[7]["contact"]["name"] = 12345  # name as a number
    out.append(agent_detail(9, nested=False))  # flat contact fields
    out.append(agent_detail(10, email=False))  # missing email -> quarantined
    return out


def day_active(day: int):
    ids = {1: [1, 2, 3, 4, 5, 6, 7, 8, 9], 2: [1, 2, 3, 4, 5], 3: [1, 2, 3, 4, 5, 6, 7, 8]}[day]
    return [{"id": i} for i in ids] + [{"id": None}, {"id": 99}]


def day_groups(day: int):
    g = [
        {"id": 100, "name": "root", "parent_group_id": None, "agent_ids": []},
        {"id": 101, "name": "mid", "parent_group_id": 100, "agent_ids": [6]},
        {"id": 102, "name": "leaf", "parent_group_id": 101, "agent_ids": [1, 55]},  # 55 unknown
        {"id": 103, "name": "loop", "parent_group_id": 103, "agent_ids": [2]},  # self-loop
        {"id": 104, "name": "cyc-a", "parent_group_id": 105, "agent_ids": [3]},  # 2-cycle
        {"id": 105, "name": "cyc-b", "parent_group_id": 104, "agent_ids": []},
        {"id": 106, "name": "orphan", "parent_group_id": 999, "agent_ids": [8]},  # parent missing
        {"id": 107, "name": "idle", "parent_group_id": 100, "agent_ids": None},
        {"id": 108, "name": "under-idle", "parent_group_id": 107, "agent_ids": [10]},  # 10 never valid
        {"id": 109, "name": "text-list", "parent_group_id": 100, "agent_ids": "4,5"},  # not a list
        {"id": None, "name": "no-id", "parent_group_id": 100, "agent_ids": [1]},
    ]
    for x in g:
        x["created_at"] = "2024-01-01T00:00:00Z"
        x["updated_at"] = f"2024-05-0{day}T00:00:00Z"
    if day == 2:
        g[1]["agent_ids"] = []  # group 101 emptied
    return g


def day_roles(day: int):
    r = [
        {"id": "1", "name": "admin", "description": "all", "default": True, "agent_type": 1,
         "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-05-01T00:00:00Z"},
        {"id": 2, "role": {"name": "agent", "description": "tickets", "default": False, "agent_type": "support",
                           "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-05-01T00:00:00Z"}},
        {"id": 3, "name": "viewer", "created_at": "not-a-time", "updated_at": "2024-05-01T00:00:00Z"},
        {"id": 3, "name": "viewer-new", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-05-02T00:00:00Z"},
        {"id": 4, "name": "lead", "updated_at": "2024-05-01T00:00:00Z"},
        {"id": None, "name": "ghost"},
        {"id": 5, "role": {"name": "auditor", "agent_type": 7}},
    ]
    return r


def day_budgets(day: int):
    def b(i, limit=100.0, **kw):
        rec = {"id": f"b{i}", "uuid": f"u-b{i}", "name": f"Budget {i}", "retired": False,
               "startDate": "2024-05-15", "recurringInterval": "monthly", "timezone": "UTC",
               "currentPeriod": {"limit": limit, "overspendBuffer": 5, "assigned": 50,
                                 "spent": {"cleared": 10, "pending": 2, "total": 12}}}
        rec.update(kw)
        return rec

    res = [b(i, limit=100.0 * day + i) for i in range(1, 10)]
    res.append(b(10, limit="250.5"))  # text limit parses
    res.append(b(11, limit=-20))  # negative passes
    res.append(b(12, limit=None))  # null limit -> quarantined
    res.append({"id": None, "currentPeriod": {"limit": 1}})  # null id -> quarantined
    res.append(b(1, limit=999.0))  # duplicate id in one snapshot
    return {"results": res}


def day_cards(day: int):
    def c(i, **kw):
        rec = {"id": f"c{i}", "uuid": f"u-c{i}", "name": f"Card {i}", "userId": "u1", "budgetId": "b1",
               "lastFour": "1234", "validThru": "12/30", "status": "active", "type": "virtual",
               "shareBudgetFunds": True, "recurring": "true", "recurringLimit": 100,
               "currentPeriod": {"limit": 500, "spent": 20 * day}, "createdTime": "2024-01-01T00:00:00Z",
               "updatedTime": f"2024-05-0{day}T00:00:00Z"}
        rec.update(kw)
        return rec

    res = [c(i) for i in range(1, 13)]
    res.append(c(13, createdTime=None))
    res.append(c(14, status=None, type=None))
    res.append(c(15, currentPeriod={"limit": -5, "spent": 0}))
    res.append(c(16, shareBudgetFunds="yes", recurringLimit=None, currentPeriod=None))  # nulls are valid
    return {"results": res}


def day_transactions(day: int):
    def t(i, amount=1000, exp=2, cur="EUR", rate=None, occurred="2024-05-01T12:00:00Z", flat=False, **kw):
        cd = {"originalCurrencyAmount": amount, "exponent": exp, "originalCurrencyCode": cur}
        if rate is not None:
            cd["exchangeRate"] = rate
        rec = {"id": f"t{i}", "uuid": f"u-t{i}", "occurredTime": occurred,
               "updatedTime": f"2024-05-0{day}T13:00:00Z", "userId": "u1", "userName": "User One",
               "merchantName": "Shop", "cardId": "c1", "budgetId": "b1"}
        if flat:
            rec.update(cd)
        else:
            rec["currencyData"] = cd
        rec.update(kw)
        return rec

    res = [
        t(1),  # API rate for EUR
        t(2, cur="USD", amount=2500),
        t(3, cur="GBP", rate=1.25),  # no API GBP rate -> payload
        t(4, cur="JPY"),  # no rate anywhere -> quarantined
        t(5, amount="1500"),  # text amount
        t(6, exp="two"),  # bad exponent -> amount null -> quarantined
        t(7, cur=840),  # currency as a number -> invalid
        t(8, amount=""),  # empty amount
        t(9, amount=0),  # zero amount
        t(10, amount=-500),  # refund: valid
        t(11, occurred="not-a-time"),
        t(12, flat=True),  # flat currency fields
        t(13, rate="0.9", cur="GBP"),  # text payload rate
        t(14, uuid=None),
        t(1),  # exact duplicate of t1
    ]
    return {"results": res}


FX_CSV = "fx_date,currency,usd_quote\n2024-05-01,EUR,0.8\n2024-05-01,INR,80\n"


def write_days(base: str) -> list[str]:
    days = []
    for d in (1, 2, 3):
        day = f"day{d}"
        root = f"{base}/sync-{day}"
        for a in day_agent_details():
            _dump(f"{root}/agent_details/{a['id'] if a['id'] is not None else 'x'}.json", a)
        _dump(f"{root}/agents/1.json", day_active(d))
        _dump(f"{root}/admin_groups/1.json", day_groups(d))
        _dump(f"{root}/roles/1.json", day_roles(d))
        _dump(f"{root}/budgets/1.json", day_budgets(d))
        _dump(f"{root}/cards/1.json", day_cards(d))
        if d != 3:
            _dump(f"{root}/transactions/1.json", day_transactions(d))
        days.append(day)
    os.makedirs(f"{base}/fx_rates", exist_ok=True)
    with open(f"{base}/fx_rates/rates.csv", "w") as f:
        f.write(FX_CSV)
    return days
