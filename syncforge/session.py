"""Session helpers: one place for the settings every job relies on.

Only settings that change *results* or *robustness* are pinned here (UTC,
AQE, skew handling). Sizing (memory, shuffle partitions) is left to the
deployment; tests pass a small ``shuffle_partitions``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

BASE_CONF = {
    # Timestamps are compared across days and engines: pin the zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ANSI stays on (Spark 4 default); the library only uses try_* casts.
    "spark.sql.ansi.enabled": "true",
    # Hierarchy rounds checkpoint to shared storage; drop files once unused.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "syncforge",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    The cluster names it in ``spark.checkpoint.dir``; we read that. Only on a
    ``local`` master, where driver and executors are one process, does an
    unset folder fall back to one under the session's warehouse directory; any
    other master must name it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
        conf_dir = warehouse.rstrip("/") + "/_checkpoints"
        if conf_dir.startswith("file:"):
            os.makedirs(conf_dir[len("file:"):], exist_ok=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where a plan would otherwise stack day upon day (a fold over days
    re-reading each previous result): the next step starts from files, and a
    lost executor recomputes at most the current step.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
