"""syncforge: entity snapshot sync as Spark DataFrame jobs.

Daily JSON snapshots are normalized, validated (bad rows quarantined with
their raw payload), deduplicated deterministically, converted to USD,
checked against referenced entities and merged into keyed current-state
tables with staleness guards, soft deletes, history, watermarks and run
metrics. Every operator is a DataFrame function usable on any table.
"""

__version__ = "0.1.0"
