"""Replace the members of every group present in a snapshot (J-09).

``next = current ▷ snapshot_groups  ∪  distinct(staged members)``: groups
listed in today's snapshot get exactly today's valid members -- also when
that list is empty -- and every other group keeps its stored members. One
anti join against the (distinct) snapshot group ids plus a union; no
per-group collection anywhere, so a group with millions of members is just
many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.operators.merge import ACTION

KEEP, INSERT = "keep", "insert"


def _group_ids(snapshot_groups: DataFrame, group_col: str) -> DataFrame:
    return snapshot_groups.select(group_col).filter(F.col(group_col).isNotNull()).distinct()


def replace_members(
    current: DataFrame,
    staged: DataFrame,
    snapshot_groups: DataFrame,
    group_col: str = "group_id",
    member_col: str = "agent_id",
) -> DataFrame:
    """Next membership table with ``_action`` ('keep' or 'insert').

    The joins hash the group ids, one row a group, and stream the members: a
    task sorts no members. A group that holds a third of all members is split
    by AQE's skew join.
    """
    groups = _group_ids(snapshot_groups, group_col).hint("shuffle_hash")
    kept = current.select(group_col, member_col).join(groups, group_col, "left_anti")
    new = (
        staged.select(group_col, member_col)
        .filter(F.col(group_col).isNotNull() & F.col(member_col).isNotNull())
        .join(groups, group_col, "left_semi")
        .distinct()
    )
    return kept.withColumn(ACTION, F.lit(KEEP)).unionByName(new.withColumn(ACTION, F.lit(INSERT)))
