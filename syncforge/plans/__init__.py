"""Plans: entity transforms, the day flow, and the registered operator queries."""

from syncforge.plans import q_entities, q_flow, q_merge, q_quarantine, q_refer, q_shape, q_state, q_validate  # noqa: F401  (register queries)
from syncforge.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
