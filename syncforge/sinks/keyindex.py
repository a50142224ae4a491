"""A stored index of a secondary key, with a Bloom filter a bucket (J-15).

Two bucketed tables go with the indexed one: ``(key, id)`` by the hash of the
key, and the bits of its keys. A key's hash names its bucket, a block of the
bucket's filter, and ``HASHES`` bits of that block; a block is one bitmap of
Spark's ``bitmap_construct_agg``. A lookup of staged keys reads the filters of
their buckets, keeps the keys whose bits are all set, and opens only the
buckets of those: a batch of new keys opens next to none. Bits of keys that
went stay set, which costs a look and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncforge.sinks.tables import BUCKET, TableStore

BITS = 8 * 4096  # of a bitmap of Spark's bitmap functions
HASHES = 5


class KeyIndex:
    def __init__(self, store: TableStore, table: str, key: str, owner: str, blocks: int = 16):
        """``blocks``: bitmaps a bucket; ten bits a key keep false alarms near one in a hundred."""
        self.store, self.key, self.owner, self.blocks = store, key, owner, blocks
        self.rows, self.filters = f"{table}_keys", f"{table}_key_bits"
        self.rows_ddl = f"{key} string, {owner} string"
        self.filters_ddl = "block int, bits binary"

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(F.lit("block"), F.col(self.key)), F.lit(self.blocks)).cast("int").alias("block")

    def _positions(self) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(self.key)), F.lit(BITS)) for i in range(HASHES)])

    def _placed(self, keys: DataFrame) -> DataFrame:
        return keys.withColumns({BUCKET: self.store.bucket(self.key), "block": self._block(), "positions": self._positions()})

    def maybe_stored(self, keys: DataFrame) -> DataFrame:
        """The distinct staged keys (with their ``bucket``) whose bits are all set."""
        placed = self._placed(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct())
        filters = self.store.read_buckets(self.filters, self.filters_ddl, self.store.touched(keys, self.key))
        hit = F.forall(
            "positions",
            lambda p: F.conv(F.hex(F.substring("bits", F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), p % 8).cast("int")) != 0,
        )
        return placed.join(filters, [BUCKET, "block"]).where(hit).select(self.key, BUCKET)

    def owners(self, keys: DataFrame) -> DataFrame:
        """``(key, owner)`` of the staged keys that are stored; untouched buckets are never opened."""
        maybe = self.maybe_stored(keys)
        buckets = maybe.select(BUCKET).where(F.col(BUCKET) >= 0).distinct()  # at most the number of buckets
        stored = self.store.read_buckets(self.rows, self.rows_ddl, buckets)
        return stored.drop(BUCKET).join(maybe.select(self.key), self.key, "left_semi")

    def stage(self, run: int, added: DataFrame, released: DataFrame) -> None:
        """Stage the index after a merge: ``added`` and ``released`` are ``(key, owner)`` rows."""
        pair = [self.key, self.owner]
        added = added.select(*pair).where(F.col(self.key).isNotNull())  # made distinct with the stored rows
        released = released.select(*pair)
        both = added.unionByName(released)
        touched = self.store.touched(both, self.key)
        stored = self.store.read_buckets(self.rows, self.rows_ddl, touched).drop(BUCKET)
        left = stored.join(released, pair, "left_anti").unionByName(added).distinct()
        self.store.stage_buckets(self.rows, run, left.withColumn(BUCKET, self.store.bucket(self.key)))
        new = self._placed(added).select(BUCKET, "block", F.explode("positions").alias("p")).groupBy(BUCKET, "block").agg(F.bitmap_construct_agg("p").alias("bits"))
        old = self.store.read_buckets(self.filters, self.filters_ddl, self.store.touched(added, self.key))
        bits = old.select(BUCKET, "block", "bits").unionByName(new).groupBy(BUCKET, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        self.store.stage_buckets(self.filters, run, bits)
        # buckets that lost their last key have no staged folder: at most the number of buckets
        emptied = [r[0] for r in touched.collect() if not self.store.has_staged(self.rows, run, r[0])]
        self.store.write_note(self._note(run), emptied)

    def _note(self, run: int) -> str:
        return f"_switch/run={run}/{self.rows}_emptied"

    def staged(self, run: int) -> bool:
        return self.store.read_note(self._note(run)) is not None

    def switch(self, run: int) -> None:
        self.store.switch_buckets(self.rows, run, self.store.read_note(self._note(run)))
        self.store.switch_buckets(self.filters, run)
