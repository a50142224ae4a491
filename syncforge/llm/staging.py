"""Intermediate results cut from their lineage, in the folder all machines share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from syncforge.session import checkpoint_dir, materialize


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    A reliable checkpoint: later steps do not recompute it, and a lost
    executor re-reads its part from the shared folder.
    """
    return materialize(df)


def written(df: DataFrame) -> DataFrame:
    """Like ``settled``, as a Parquet table: columns that repeat (names of files) take next to no room."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
