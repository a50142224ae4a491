"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import compare, duck  # noqa: E402
from syncforge.plans import ORACLE, QUERIES  # noqa: E402

SF_DIR = os.environ.get("SYNCFORGE_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, f"{name} has no oracle"
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert r["schema"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values"], r


def test_entry_contract():
    import importlib.util

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(root, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.queries()) >= set(QUERIES)
    assert set(mod.oracle_sql()) <= set(mod.queries())
