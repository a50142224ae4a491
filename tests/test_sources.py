from __future__ import annotations

import json
import os

import pytest

from syncforge import schemas as S
from syncforge.sources.readers import read, read_optional
from syncforge.sources.snapshots import day_path


def test_unknown_format_raises(spark, tmp_root):
    with pytest.raises(ValueError):
        read(spark, tmp_root, "xml")


def test_format_case_insensitive_and_recursive(spark, tmp_root):
    os.makedirs(f"{tmp_root}/a/b")
    with open(f"{tmp_root}/a/b/x.json", "w") as f:
        json.dump([{"id": 1}, {"id": "two"}], f)
    df = read(spark, tmp_root, "JSON", S.envelope(S.ACTIVE_AGENT_RECORD))
    assert sorted(r.id for r in df.collect()) == ["1", "two"]  # numbers as text, never a failure


def test_csv_and_parquet(spark, tmp_root):
    with open(f"{tmp_root}/r.csv", "w") as f:
        f.write("fx_date,currency,usd_quote\n2024-05-01,EUR,0.8\n")
    df = read(spark, tmp_root, "csv", S.FX_RATES_DDL)
    assert df.first().usd_quote == 0.8
    df.write.parquet(f"{tmp_root}/p")
    assert read(spark, f"{tmp_root}/p", "parquet").count() == 1


def test_missing_optional_source(spark, tmp_root):
    df, ok = read_optional(spark, f"{tmp_root}/nope", "json", S.envelope(S.CARD_RECORD))
    assert not ok and df.count() == 0 and "results" in df.columns


def test_day_path():
    assert day_path("s3a://bucket/data/", "day1", "cards") == "s3a://bucket/data/sync-day1/cards"
    assert day_path("/x", "sync-day2", "roles") == "/x/sync-day2/roles"
