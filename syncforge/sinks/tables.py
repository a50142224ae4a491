"""Table store on shared storage (A-11..A-13, A-16, J-10..J-12, K-03).

* **Complete tables** (agents, groups, roles: daily snapshots touch every row)
  are versioned: each merge writes a new folder ``<table>/v=<n>``; the reader
  takes the highest one with a ``_SUCCESS`` marker. A plan never overwrites
  the folder it reads. Older versions stay unless ``keep_versions`` is given.
* **Bucketed tables** (transactions, cards, budgets: daily deltas) are
  partitioned by the hash of their key. A merge reads the buckets that the
  staged keys fall into (dynamic partition pruning), writes their next state
  to a staging folder, and only when that is complete switches the folders of
  these buckets. A switch that died half way is repeated from the staging
  folder, so its cost and its effect are those of the day's keys alone.
* **Staging, quarantine, logs** have a folder per day and step that is replaced
  as a whole, also by no rows.
* **Ledger**: one marker per run of a day and step, written after all of the
  step's tables; what it holds is what the step reported.

Paths go through the Hadoop FileSystem API, so the same code runs on local
disk, HDFS or an object store.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge.functions.keys import bucket_of

BUCKET = "bucket"
LEDGER = "_ledger"
SWITCH = "_switch"
CODEC = "zstd"  # of all tables: records of text take half the room of snappy


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, keep_versions: int | None = None):
        """``buckets``: folders of each bucketed table, fixed for the life of the store."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions
        known = self.read_note("_buckets")
        if known is not None and known != buckets:
            raise ValueError(f"this store has {known} buckets a table, not {buckets}")
        self.buckets = buckets
        if known is None:
            self.write_note("_buckets", buckets)

    # -- filesystem helpers -------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def _names(self, path: str) -> list[str]:
        p, fs = self._fs(path)
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, path: str) -> None:
        p, fs = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    def _numbers(self, path: str, prefix: str) -> list[int]:
        return sorted(int(n[len(prefix):]) for n in self._names(path) if n.startswith(prefix) and n[len(prefix):].isdigit())

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # -- notes: single values beside the tables -----------------------------
    def write_note(self, name: str, value) -> None:
        p, fs = self._fs(f"{self.root}/{name}.json")
        out = fs.create(p, True)
        out.write(json.dumps(value).encode())
        out.close()

    def read_note(self, name: str):
        path = f"{self.root}/{name}.json"
        if not self._exists(path):
            return None
        p, fs = self._fs(path)
        source = fs.open(p)
        try:
            return json.loads(bytes(source.readAllBytes()))
        finally:
            source.close()

    # -- ledger -------------------------------------------------------------
    def run_number(self, day: str) -> int:
        """The unfinished run of this day, else the next number."""
        known = self._numbers(self.path(LEDGER), "run=")
        for n in reversed(known):
            if self.read_note(f"{LEDGER}/run={n}/_day") == day and not self.committed(n, "_finished"):
                return n
        n = max(known, default=0) + 1
        self.write_note(f"{LEDGER}/run={n}/_day", day)
        return n

    def finished_run(self, day: str) -> int | None:
        """The last finished run of this day."""
        for n in reversed(self._numbers(self.path(LEDGER), "run=")):
            if self.read_note(f"{LEDGER}/run={n}/_day") == day and self.committed(n, "_finished"):
                return n
        return None

    def committed(self, run: int, step: str) -> bool:
        return self._exists(f"{self.path(LEDGER)}/run={run}/{step}.json")

    def commit(self, run: int, step: str, report=None) -> None:
        self.write_note(f"{LEDGER}/run={run}/{step}", report)

    def report(self, run: int, step: str):
        return self.read_note(f"{LEDGER}/run={run}/{step}")

    # -- versioned tables ---------------------------------------------------
    def versions(self, table: str) -> list[int]:
        return [v for v in self._numbers(self.path(table), "v=") if self._exists(f"{self.path(table)}/v={v}/_SUCCESS")]

    def current_version(self, table: str, below: int | None = None) -> int | None:
        v = [x for x in self.versions(table) if below is None or x < below]
        return v[-1] if v else None

    def read(self, table: str, ddl: str, below: int | None = None) -> DataFrame:
        """Current version (with ``below``, the last one before that), or an empty frame of ``ddl``."""
        v = self.current_version(table, below)
        if v is None:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(f"{self.path(table)}/v={v}")

    def write_version(self, table: str, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as the next version, or as the given one (replacing what an uncommitted run left there)."""
        v = version if version is not None else (self.current_version(table) or 0) + 1
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path(table)}/v={v}")
        if self.keep_versions:
            self.vacuum(table, self.keep_versions)
        return v

    def vacuum(self, table: str, keep: int = 2) -> None:
        for v in self.versions(table)[:-keep]:
            self._delete(f"{self.path(table)}/v={v}")

    # -- bucketed tables ----------------------------------------------------
    def bucket(self, *keys):
        return bucket_of(self.buckets, *keys).alias(BUCKET)

    def touched(self, keys: DataFrame, *names: str) -> DataFrame:
        """The buckets these keys fall into: at most ``buckets`` rows, whatever the size of ``keys``."""
        return keys.select(self.bucket(*names)).where(F.col(BUCKET) >= 0).distinct()

    def read_buckets(self, table: str, ddl: str, touched: DataFrame | None = None) -> DataFrame:
        """Stored rows with their ``bucket``; with ``touched`` only of those buckets, found at run time.

        The broadcast holds a number a bucket, and Spark prunes the folders by it.
        """
        path = f"{self.path(table)}/current"
        schema = f"{ddl}, {BUCKET} int"
        if not any(n.startswith(f"{BUCKET}=") for n in self._names(path)):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(path)
        return df if touched is None else df.join(F.broadcast(touched), BUCKET, "left_semi")

    def staged_buckets(self, table: str, run: int) -> str | None:
        """The complete staging folder of a run, if there is one."""
        path = f"{self.root}/{SWITCH}/run={run}/{table}"
        return path if self._exists(f"{path}/_SUCCESS") else None

    def stage_buckets(self, table: str, run: int, rows: DataFrame) -> str:
        """Write the next state of the buckets of ``rows`` (with their ``bucket``) beside the table."""
        path = f"{self.root}/{SWITCH}/run={run}/{table}"
        # one task a bucket where buckets are small, several where they are not
        rows.hint("rebalance", BUCKET).write.mode("overwrite").option("compression", CODEC).partitionBy(BUCKET).parquet(path)
        return path

    def write_staged(self, name: str, run: int, rows: DataFrame) -> DataFrame:
        """Rows that the steps of a switch share, written once beside what it stages; they go with it."""
        path = f"{self.root}/{SWITCH}/run={run}/{name}"
        rows.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def has_staged(self, table: str, run: int, bucket: int) -> bool:
        return self._exists(f"{self.root}/{SWITCH}/run={run}/{table}/{BUCKET}={bucket}")

    def switch_buckets(self, table: str, run: int, emptied: Sequence[int] = ()) -> None:
        """Put the staged buckets in the place of the stored ones; may be repeated until it went through."""
        path = f"{self.root}/{SWITCH}/run={run}/{table}"
        current = f"{self.path(table)}/current"
        p, fs = self._fs(current)
        fs.mkdirs(p)
        for b in emptied:
            self._delete(f"{current}/{BUCKET}={b}")
        for name in self._names(path):
            if name.startswith(f"{BUCKET}="):
                self._delete(f"{current}/{name}")
                to, fs = self._fs(f"{current}/{name}")
                if not fs.rename(self._fs(f"{path}/{name}")[0], to):
                    raise OSError(f"cannot move {path}/{name}")

    def drop_table(self, table: str) -> None:
        self._delete(self.path(table))

    def drop_staged(self, run: int) -> None:
        self._delete(f"{self.root}/{SWITCH}/run={run}")

    # -- staging, quarantine, logs: a folder per day and step ----------------
    def overwrite_partitions(self, table: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy(*partition_by).parquet(self.path(table))

    def overwrite_folder(self, table: str, df: DataFrame, **parts) -> DataFrame:
        """Replace one partition folder, also by an empty frame; returns the rows read back."""
        path = "/".join([self.path(table), *(f"{k}={v}" for k, v in parts.items())])
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read_partitioned(self, table: str, ddl: str) -> DataFrame:
        """All rows of a partitioned table, in the declared types; names of folders that ``ddl`` lacks come last."""
        if not self._names(self.path(table)):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(self.path(table))

    read_log = read_partitioned

    def drop_partition(self, table: str, column: str, value: str) -> None:
        """A-16: remove a processed staging partition."""
        self._delete(f"{self.path(table)}/{column}={value}")
