"""Properties of the rule engine: valid + quarantined = input, first failure wins."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from syncforge.operators.validate import Rule, null_or_non_negative, required, split_valid

ROW = st.tuples(
    st.one_of(st.none(), st.integers(-5, 5)),
    st.one_of(st.none(), st.text(alphabet="ab", max_size=2)),
    st.one_of(st.none(), st.floats(-10, 10, allow_nan=False)),
)


def _rules():
    return [
        required("E1", "id missing", "id"),
        Rule("E2", "name empty", F.col("name") == F.lit("")),
        null_or_non_negative("E3", "negative amount", "amount"),
    ]


def _expected(row):
    i, name, amount = row
    if i is None:
        return "id missing"
    if name == "":
        return "name empty"
    if amount is not None and amount < 0:
        return "negative amount"
    return None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=0, max_size=30))
def test_split_is_a_partition_and_first_failure_wins(spark, rows):
    df = spark.createDataFrame(rows, "id int, name string, amount double").withColumn(
        "_pos", F.monotonically_increasing_id()
    )
    valid, errors = split_valid(df, _rules(), "t", F.col("_pos"), F.to_json(F.struct("*")))
    got_valid = {r._pos for r in valid.collect()}
    got_err = {int(r.record_key): r.error_message for r in errors.collect()}
    positions = [r._pos for r in df.select("_pos").collect()]
    assert len(got_valid) + len(got_err) == len(rows)
    assert got_valid.isdisjoint(got_err)
    ordered = dict(zip(positions, rows))
    for pos, row in ordered.items():
        exp = _expected(row)
        assert (pos in got_valid) if exp is None else (got_err.get(pos) == exp)
