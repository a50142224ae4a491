"""File scans (A-01..A-05, A-17).

All readers take a declared schema when one is known: no inference pass
over the data, and a drifting field cannot re-type a whole column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("json", "csv", "parquet")


def read(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Generic scan of a file or folder tree; ``fmt`` is case-insensitive.

    JSON: multi-line documents (one object or array per file) by default --
    such files are not splittable, scale comes from many files; pass
    ``multiline=False`` for JSON-lines, which splits. CSV: header row.
    """
    fmt = (fmt or "").lower()
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    r = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        r = r.schema(schema)
    if fmt == "json":
        return r.option("multiLine", multiline).json(path)
    if fmt == "csv":
        r = r.option("header", "true")
        if schema is None:
            r = r.option("inferSchema", "true")
        return r.csv(path)
    return r.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (s3a, hdfs, file)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_optional(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    multiline: bool = True,
) -> tuple[DataFrame, bool]:
    """A-17: (frame, present). A missing folder gives an empty frame of the
    declared schema instead of a PATH_NOT_FOUND failure."""
    if not path_exists(spark, path):
        return empty(spark, schema), False
    return read(spark, path, fmt, schema, multiline), True
