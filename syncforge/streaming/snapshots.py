"""Structured Streaming driver for the envelope entities (K, optional).

New snapshot files under ``<base>/sync-*/<folder>/`` are picked up by a file
stream with the entity's declared schema. A micro-batch is a day of the flow:
``foreachBatch`` runs the entity's step on its records, with its own run in
the store's ledger, so quarantine, key check, watermark, history and metrics
are those of the batch flow, in the same tables and the same layout. The
day of a record, and which record of a key came last, follow from the file it
came from, so one micro-batch may hold many days.

The stream's checkpoint records which files were processed; a replayed
micro-batch finds its run finished in the ledger and changes nothing.

``trigger(availableNow=True)`` turns this into an incremental batch job:
process what arrived since the last run, then stop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from syncforge.plans.flow import BUCKETED, DayContext, finish, run_step
from syncforge.sinks.tables import TableStore
from syncforge.sources.lineage import with_lineage
from syncforge.sources.snapshots import SOURCES


def apply_batch(name: str, store: TableStore, batch: DataFrame, epoch_id: int, fx_rates: DataFrame | None = None) -> bool:
    """Run one micro-batch, once; False if it was applied before."""
    if name not in BUCKETED:
        raise ValueError(f"streaming supports {', '.join(sorted(BUCKETED))}, not {name!r}")
    day = f"stream-{name}-{epoch_id}"
    if store.finished_run(day) is not None:
        return False
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ctx = DayContext(batch.sparkSession, "", day, store, now, day, fx_rates, raw={name: batch})
    run_step(ctx, name)
    finish(ctx)
    return True


def sync_stream(
    spark: SparkSession,
    base: str,
    name: str,
    store: TableStore,
    checkpoint_location: str,
    fx_rates: DataFrame | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the stream for one entity; returns the StreamingQuery."""
    if name not in BUCKETED:
        raise ValueError(f"streaming supports {', '.join(sorted(BUCKETED))}, not {name!r}")
    src = SOURCES[name]
    reader = spark.readStream.schema(src.schema).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = with_lineage(reader.json(f"{base.rstrip('/')}/sync-*/{src.folder}/"))
    writer = stream.writeStream.foreachBatch(lambda batch, epoch: apply_batch(name, store, batch, epoch, fx_rates) and None).option(
        "checkpointLocation", checkpoint_location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
