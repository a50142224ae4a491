"""Groups and their members (B-17, C-08, D-02, D-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import row_json, try_long, try_timestamp
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import explode_ids, unwrap
from syncforge.operators.refer import split_known
from syncforge.operators.validate import required, split_valid, to_quarantine

ENTITY = "groups"
MEMBERS = "group_membership"
# Quarantine types and messages.
MISSING_ID = ("MISSING_GROUP_ID", "group id is null")
UNKNOWN_AGENT = ("INVALID_AGENT_ID", "agent_id does not exist in agents table")
BAD_LIST = ("INVALID_AGENT_IDS", "agent_ids is not a list of ids")
BAD_ELEMENT = ("INVALID_AGENT_IDS", "element of agent_ids is not an id")

GROUP_COLUMNS = ("group_id", "name", "parent_group_id", "created_at", "updated_at")


def transform(
    raw: DataFrame,
    agents: DataFrame,
    day: str | None = None,
    run_ts=None,
    hold: list | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(groups, valid members, snapshot group ids, quarantine rows).

    A group without an id is quarantined with its member list; members that
    are not known agents are quarantined one by one; an empty or NULL list
    is a group without members (it still clears stored members). A list that
    is no list keeps its group out of the snapshot ids; an element that is no
    id is quarantined.
    """
    d = unwrap(raw, "results").select("rec.*")
    g = d.select(
        try_long("id").alias("group_id"),
        F.col("name"),
        try_long("parent_group_id").alias("parent_group_id"),
        try_timestamp("created_at").alias("created_at"),
        try_timestamp("updated_at").alias("updated_at"),
        F.col("agent_ids").cast("string").alias("agent_ids"),
        row_json(*[F.col(c) for c in d.columns]).alias("_raw"),
    )
    valid, errors = split_valid(
        g, [required(*MISSING_ID, "group_id")], ENTITY, F.col("group_id"), F.col("_raw"), day, run_ts, hold=hold
    )
    groups = latest_per_key(valid, ["group_id"], ["updated_at desc_nulls_last"], tie_break=[F.xxhash64("_raw").desc()])

    parsed = F.from_json(F.col("agent_ids"), "array<string>")
    bad_list = groups.filter(F.col("agent_ids").isNotNull() & parsed.isNull())
    members = explode_ids(groups, ["group_id"], "agent_ids", "agent_id", text="element")
    bad_element = members.filter(F.col("element").isNotNull() & F.col("agent_id").isNull())
    members = members.drop("element")
    ref = agents.select(F.col("agent_id").cast("bigint").alias("agent_id"))
    known, unknown = split_known(members, ref, ["agent_id"])
    errors = (
        errors.unionByName(
            to_quarantine(
                unknown, MEMBERS, F.col("group_id"), F.to_json(F.struct("group_id", "agent_id")), *UNKNOWN_AGENT, day, run_ts
            )
        ).unionByName(
            to_quarantine(
                bad_list, MEMBERS, F.col("group_id"), F.to_json(F.struct("group_id", "agent_ids")), *BAD_LIST, day, run_ts
            )
        )
    )
    errors = errors.unionByName(
        to_quarantine(
            bad_element, MEMBERS, F.col("group_id"), F.to_json(F.struct("group_id", "element")), *BAD_ELEMENT, day, run_ts
        )
    )
    # a list that could not be read says nothing about the members: they stay
    snapshot_groups = groups.filter(F.col("agent_ids").isNull() | parsed.isNotNull()).select("group_id")
    return groups.select(*GROUP_COLUMNS), known.distinct(), snapshot_groups, errors
