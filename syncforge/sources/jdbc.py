"""Optional JDBC connector (A-09, A-10, A-14) over Spark's own JDBC source.

Not used by the default flow (core tables live in shared storage); kept for
deployments that land staging or core tables in a relational database. The
driver jar must be on the classpath.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    columns: Sequence[str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A-09: keyed table scan; with ``partition_column`` the read is split into
    ``num_partitions`` parallel range queries instead of one connection."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions or spark.sparkContext.defaultParallelism)
        )
    df = r.load()
    return df.select(*columns) if columns else df  # pruned columns reach the SELECT


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict | None = None,
    json_text_columns: bool = False,
    batch_size: int = 10_000,
) -> None:
    """A-11/A-12/A-14: write a frame; ``json_text_columns`` lets the database
    cast text into JSON columns (``stringtype=unspecified``)."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if json_text_columns:
        w = w.option("stringtype", "unspecified")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
