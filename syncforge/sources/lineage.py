"""Where a record came from (A-06, B-10): the file's path and time, and the day its path names.

A scan adds both columns; they decide the day of a record and, of records of
one key, which came last, also when one batch holds the files of many days.
Frames without them (records from elsewhere) have the day they are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncforge.schemas import FILE, FILE_TIME

#: Order of records of one key: the file written last, then the greater path.
LATEST_FILE = (f"{FILE_TIME} desc_nulls_last", f"{FILE} desc_nulls_last")


def with_lineage(scan: DataFrame) -> DataFrame:
    """A file scan with the path and the time of each row's file."""
    return scan.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias(FILE_TIME))


def file_day(path: str | Column = FILE) -> Column:
    """The day in ``.../sync-<day>/...``; NULL if the path names none."""
    path = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(path, "/sync-([^/]+)/", 1), F.lit(""))


def day_of(df: DataFrame, day: str | None) -> Column:
    given = F.lit(day).cast("string")
    return F.coalesce(file_day(), given) if FILE in df.columns else given


def lineage(df: DataFrame) -> list[Column]:
    """Both columns, NULL where the frame has none."""
    kinds = {FILE: "string", FILE_TIME: "timestamp"}
    return [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
