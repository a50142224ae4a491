"""Agent-role pairs from the details archive, checked against the roles
master (A-08, B-16, D-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import try_long, try_timestamp
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import column_or_null, explode_ids, unwrap
from syncforge.operators.refer import split_known
from syncforge.operators.validate import to_quarantine

ENTITY = "agent_roles"
# Quarantine types and messages.
UNKNOWN_ROLE = ("INVALID_ROLE_ID", "Role ID not found in roles master")
UNKNOWN_AGENT = ("INVALID_AGENT_ID", "agent_id does not exist in agents table")
BAD_LIST = ("INVALID_ROLE_IDS", "role_ids is not a list of ids")
BAD_ELEMENT = ("INVALID_ROLE_IDS", "element of role_ids is not an id")


def transform(
    details: DataFrame,
    roles: DataFrame,
    day: str | None = None,
    run_ts=None,
    role_col: str = "role_id",
    agents: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid (agent_id, role_id) pairs, quarantine rows, agents whose list could not be read).

    An agent sent several times counts with its latest record.

    ``roles`` is the roles master: any frame with a ``role_col`` column.
    A ``role_ids`` value that is not a JSON list quarantines the agent's row;
    an empty or NULL list simply yields no pairs. With ``agents`` given,
    pairs of unknown agents are quarantined too (the mapping references
    agents).
    """
    rec = unwrap(details, "results").select("rec.*")
    d = rec.select(
        try_long("id").alias("agent_id"),
        F.col("role_ids").cast("string").alias("role_ids"),
        try_timestamp(column_or_null(rec, "updated_at")).alias("updated_at"),
    )
    latest = latest_per_key(
        d.filter(F.col("agent_id").isNotNull()),
        ["agent_id"],
        ["updated_at desc_nulls_last"],
        tie_break=[F.xxhash64("role_ids").desc()],
    )
    d = latest.unionByName(d.filter(F.col("agent_id").isNull()))
    parsed = F.from_json(F.col("role_ids"), "array<string>")
    bad_list = d.filter(F.col("role_ids").isNotNull() & parsed.isNull())
    pairs = explode_ids(latest, ["agent_id"], "role_ids", "role_id", text="element")
    bad_element = pairs.filter(F.col("element").isNotNull() & F.col("role_id").isNull())
    pairs = pairs.drop("element")
    ref = roles.select(F.col(role_col).cast("bigint").alias("role_id"))
    known, unknown = split_known(pairs, ref, ["role_id"])
    errors = to_quarantine(
        unknown, ENTITY, F.col("role_id"), F.to_json(F.struct("agent_id", "role_id")), *UNKNOWN_ROLE, day, run_ts
    ).unionByName(
        to_quarantine(
            bad_list, ENTITY, F.col("agent_id"), F.to_json(F.struct("agent_id", "role_ids")), *BAD_LIST, day, run_ts
        )
    ).unionByName(
        to_quarantine(
            bad_element, ENTITY, F.col("agent_id"), F.to_json(F.struct("agent_id", "element")), *BAD_ELEMENT, day, run_ts
        )
    )
    if agents is not None:
        known, stray = split_known(known, agents.select(F.col("agent_id").cast("bigint")), ["agent_id"])
        errors = errors.unionByName(
            to_quarantine(
                stray, ENTITY, F.col("agent_id"), F.to_json(F.struct("agent_id", "role_id")), *UNKNOWN_AGENT, day, run_ts
            )
        )
    unread = bad_list.select("agent_id").filter(F.col("agent_id").isNotNull()).distinct()
    return known.distinct(), errors, unread
