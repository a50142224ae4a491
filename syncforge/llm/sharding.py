"""Sharding by longest processing time: equal texts stay together, shards get nearly equal bytes.

The sizes of groups of equal texts are summed first. Groups are dealt to
``buckets`` by the hash of their text; in a bucket they arrive sorted by size
(Spark sorts and spills) and each goes to the least-loaded of the bucket's
bins, kept in a heap, so a task holds one heap and no groups. The bins of all
buckets, at most ``buckets * shards`` rows, are then placed on the shards by
the same rule. The law that holds is ``bytes``.

A text's size is its UTF-8 bytes plus 1 (null: 0 plus 1). Null texts form one
group, empty texts another. Ties in size go by the text's hash, ties in load
to the lowest shard. Equal keys and repeated rows are placed like any others
of their text. Slots number each shard's rows from 0 without gaps; which row
of a shard has which slot is fixed by key, text and an internal salt. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import settled

SHARDS = 8
BUCKETS = 256
SALTS = 256


def lpt(sizes: Iterable[int], shards: int) -> Iterator[int]:
    """Shard of each size (in descending order): the least-loaded, the lowest on a tie."""
    heap = [(0, s) for s in range(shards)]
    for size in sizes:
        load, s = heap[0]
        heapq.heapreplace(heap, (load + size, s))
        yield s


def text_key(text: Column) -> Column:
    """16 bytes that tell texts apart; null has a value of its own."""
    return F.coalesce(F.unhex(F.md5(text.cast("string"))), F.lit(b"null"))


def _bins(shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heap = None, []
        for b in batches:
            out = []
            for bucket, size in zip(b.column("bucket").to_pylist(), b.column("size").to_pylist(), strict=True):
                if bucket != now:
                    now, heap = bucket, [(0, s) for s in range(shards)]
                load, s = heap[0]
                heapq.heapreplace(heap, (load + size, s))
                out.append(s)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("bucket", "group", "size", "rows")), pa.array(out, pa.int32())], names=["bucket", "group", "size", "rows", "bin"])

    return run


def assign(groups: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS) -> DataFrame:
    """``group`` and ``shard`` of rows ``group`` (binary, distinct), ``size`` and ``rows`` (long)."""
    bucket = F.pmod(F.xxhash64("group"), F.lit(buckets)).cast("int")
    dealt = groups.select(bucket.alias("bucket"), "group", "size", "rows").repartition(F.col("bucket")).sortWithinPartitions("bucket", F.desc("size"), "group")
    binned = settled(dealt.mapInArrow(_bins(shards), "bucket int, group binary, size long, rows long, bin int"))
    # at most buckets * shards rows
    bins = sorted(binned.groupBy("bucket", "bin").agg(F.sum("size").alias("size")).collect(), key=lambda r: (-r["size"], r["bucket"], r["bin"]))
    placed = [(r["bucket"], r["bin"], s) for r, s in zip(bins, lpt((r["size"] for r in bins), shards), strict=True)]
    table = groups.sparkSession.createDataFrame(placed, "bucket int, bin int, shard int")
    return binned.join(F.broadcast(table), ["bucket", "bin"]).select("group", "shard")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, buckets: int = BUCKETS, salts: int = SALTS) -> DataFrame:
    """Per document: key, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` (null under this law)."""
    t = F.col(text).cast("string")
    rows = settled(
        docs.select(
            F.col(key).cast("long").alias("key"),
            (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(F.encode(t, "utf-8")), F.lit(0)).cast("long").alias("text_crc32"),
            text_key(t).alias("group"),
        )
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    # settled before numbering: equal rows keep their places when a task runs again
    salted = rows.join(assign(groups, shards, buckets), "group").withColumn("salt", F.pmod(F.xxhash64("key", "group"), F.lit(salts)).cast("int"))
    placed = settled(salted.select("key", "size", "text_crc32", "shard", "salt"))
    counts = placed.groupBy("shard", "salt").agg(F.count("*").alias("n"))  # at most shards * salts rows
    before = counts.select("shard", "salt", (F.sum("n").over(Window.partitionBy("shard").orderBy("salt")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("key", "text_crc32", "size")) - 1
    numbered = placed.withColumn("own", own).join(F.broadcast(before), ["shard", "salt"])
    return numbered.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("own")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Writes ``docs`` partitioned by ``shard`` under ``path``; returns the table of groups and shards it used."""
    t = F.col(text).cast("string")
    sized = docs.select(text_key(t).alias("group"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"))
    placed = settled(assign(sized.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("rows")), shards))
    docs.withColumn("group", text_key(t)).join(placed, "group").drop("group").write.partitionBy("shard").parquet(path)
    return placed
