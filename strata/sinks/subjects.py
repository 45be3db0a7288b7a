"""Which partitions hold which subject: erasure that reads and rewrites only those.

``<path>._subjects`` lists the distinct subjects of every day folder of a
lake, partitioned like the lake, and what each folder held when it was listed.
An erasure first lists folders anew that have changed since (so a stale index
can't hide rows), looks the subjects up, rewrites the days that hold one of
them, keeping the lake's layout and its marks, and returns those days: only
their outputs have to be computed again. Other days' files aren't touched.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sinks.compaction import rewrite_days
from strata.sinks.swap import (
    delete_path,
    finish_swap,
    listing,
    observe,
    partition_folders,
    partition_levels,
    path_exists,
    read_text,
    write_text,
)

SUBJECT = "_subject"


def subject_index(path: str) -> str:
    return path.rstrip("/") + "._subjects"


def _held(spark: SparkSession, path: str, folders: dict[str | None, str]) -> dict[str, str]:
    files = {name: json.dumps(listing(spark, f"{path}/{name}")) for name in folders.values()}
    return {name: hashlib.sha256(text.encode()).hexdigest() for name, text in files.items()}


def _in_days(column: str, days: list[str | None]):
    text = F.col(column).cast("string")
    found = text.isin([d for d in days if d is not None])
    return F.coalesce(found, F.lit(False)) | text.isNull() if None in days else found


def refresh_subjects(spark: SparkSession, path: str, key: str, partition_col: str = "event_date") -> list[str]:
    """List the subjects of every day folder that is new or has changed; returns those folders' names."""
    path, index = path.rstrip("/"), subject_index(path)
    folders = partition_folders(spark, path, partition_col)
    noted = f"{index}/_held"
    before = json.loads(read_text(spark, noted)) if path_exists(spark, noted) else {}
    now = _held(spark, path, folders)
    stale = {value: name for value, name in folders.items() if before.get(name) != now[name]}
    for name in [*stale.values(), *(n for n in before if n not in now)]:
        if path_exists(spark, f"{index}/{name}"):
            delete_path(spark, f"{index}/{name}")
    if stale:
        rows = spark.read.parquet(path).filter(_in_days(partition_col, list(stale)))
        listed = rows.select(F.col(partition_col), F.col(key).cast("string").alias(SUBJECT)).distinct()
        listed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(index)
    write_text(spark, noted, json.dumps(now))
    return sorted(stale.values())


def days_of(spark: SparkSession, path: str, subjects: DataFrame, partition_col: str = "event_date") -> list[str | None]:
    """Days (as text) that hold one of ``subjects`` (its first column), from the index."""
    index = subject_index(path)
    if not path_exists(spark, index):
        return []
    schema = StructType([StructField(SUBJECT, StringType()), StructField(partition_col, StringType())])
    listed = spark.read.schema(schema).parquet(index)
    wanted = subjects.select(F.col(subjects.columns[0]).cast("string").alias(SUBJECT))
    return [r[0] for r in listed.join(wanted, SUBJECT, "left_semi").select(partition_col).distinct().collect()]


def erase_days(
    spark: SparkSession, path: str, subjects: DataFrame, key: str, days: list[str | None], partition_col: str
) -> list[str | None]:
    """Rewrite the given days without the subjects' rows; ``days`` as text."""
    path = path.rstrip("/")
    finish_swap(spark, path)
    folders = partition_folders(spark, path, partition_col)
    days = [d for d in days if d in folders]
    if not days:
        return []
    levels = partition_levels(spark, path)
    seen = observe(spark, path, [folders[d] for d in days])
    rows = spark.read.parquet(path).filter(_in_days(partition_col, days))
    gone = subjects.select(F.col(subjects.columns[0]).cast("string").alias(SUBJECT)).distinct()
    kept = rows.join(gone, F.col(key).cast("string") == gone[SUBJECT], "left_anti")
    rewrite_days(spark, path, kept, list(seen), seen, levels)
    return days


def erase_indexed(
    spark: SparkSession, path: str, subjects: DataFrame, key: str, partition_col: str = "event_date"
) -> list[str | None]:
    """Erase subjects (the first column of ``subjects``) from a day-partitioned lake; returns the rewritten days."""
    finish_swap(spark, path)
    refresh_subjects(spark, path, key, partition_col)
    days = erase_days(spark, path, subjects, key, days_of(spark, path, subjects, partition_col), partition_col)
    refresh_subjects(spark, path, key, partition_col)
    return days
