"""Day snapshot addressing (A-06..A-08): ``<base>/sync-<day>/<entity>/``.

The path is built by string concatenation, so ``s3a://``, ``hdfs://`` and
local bases all work. Each entity has a declared read schema; a document that
cannot be read arrives as one record holding its text (``schemas.captured``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from syncforge import schemas as S
from syncforge.sources.lineage import with_lineage
from syncforge.sources.readers import read_optional


@dataclass(frozen=True)
class Source:
    folder: str
    schema: StructType
    mandatory: bool


# folder names of the daily export and the schema each is read with
SOURCES = {
    "agent_details": Source("agent_details", S.envelope(S.captured(S.AGENT_DETAIL_RECORD)), True),
    "agents": Source("agents", S.envelope(S.captured(S.ACTIVE_AGENT_RECORD)), True),
    "groups": Source("admin_groups", S.envelope(S.captured(S.GROUP_RECORD)), True),
    "roles": Source("roles", S.envelope(S.captured(S.ROLE_RECORD)), False),
    "budgets": Source("budgets", S.wrapped(S.captured(S.BUDGET_RECORD), "budget"), False),
    "cards": Source("cards", S.envelope(S.captured(S.CARD_RECORD)), False),
    "transactions": Source("transactions", S.envelope(S.captured(S.TRANSACTION_RECORD)), False),
}


def day_path(base: str, day: str, folder: str) -> str:
    day = str(day)
    tag = day if day.startswith("sync-") else f"sync-{day}"
    return f"{base.rstrip('/')}/{tag}/{folder}"


def read_day(spark: SparkSession, base: str, day: str, name: str, multiline: bool = True) -> tuple[DataFrame, bool]:
    """(raw frame, present) for one entity of one day."""
    src = SOURCES[name]
    raw, present = read_optional(spark, day_path(base, day, src.folder), "json", src.schema, multiline)
    return (with_lineage(raw) if present else raw), present
