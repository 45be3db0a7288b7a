"""Compaction of date partitions that an ingest filled with small files."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.swap import MARKS, child_names, finish_swap, observe, path_exists, read_text, replace, write_text

#: Partition level under the day: which batch of which ingest query wrote the rows.
INGEST_COL = "_ingest"


def merged_epochs(spark: SparkSession, path: str, days: list[str]) -> dict[str, dict[str, int]]:
    """Per day folder and ingest query, the last epoch whose rows a rewrite has merged."""
    found = {}
    for day in days:
        marks = f"{path.rstrip('/')}/{day}/{MARKS}"
        if path_exists(spark, marks):
            found[day] = json.loads(read_text(spark, marks))
    return found


def _epochs(spark: SparkSession, path: str, day: str) -> dict[str, int]:
    """The newest epoch of each query in a day, merged ones included."""
    seen = merged_epochs(spark, path, [day]).get(day, {})
    for name in child_names(spark, f"{path.rstrip('/')}/{day}"):
        query, _, epoch = name.removeprefix(f"{INGEST_COL}=").rpartition("-epoch")
        if query:
            seen[query] = max(seen.get(query, -1), int(epoch))
    return seen


def rewrite_days(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    days: list[str],
    seen: dict[str, list[str] | None],
    levels: list[str],
    max_records: int | None = None,
) -> None:
    """Replace day folders of a lake by ``rows``; ``seen`` was observed before ``rows`` was made.

    An ingested lake keeps its level below the day: the rows get one new batch
    name, and each day's marks say which epochs are in it, so that a replay of
    them isn't written again. Marks and rows of a day move in together.
    """
    ingested = INGEST_COL in levels
    if ingested:
        rows = rows.withColumn(INGEST_COL, F.lit(f"merged_{uuid.uuid4().hex}"))
    marks = {d: _epochs(spark, path, d) for d in days} if ingested else {}

    def write(folder: str) -> None:
        w = rows.write.partitionBy(*levels)
        (w.option("maxRecordsPerFile", max_records) if max_records else w).parquet(folder)
        for day, epochs in marks.items():
            if epochs:  # also for a day that has no rows any more
                write_text(spark, f"{folder}/{day}/{MARKS}", json.dumps(epochs))

    replace(spark, path, write, names=days, seen=seen)


def compact_partitions(
    spark: SparkSession,
    path: str,
    dates: list[str],
    partition_col: str = "event_date",
    rows_per_file: int = 1_000_000,
) -> dict[str, int]:
    """Rewrite the given partitions into files of about ``rows_per_file`` rows.

    Each day is split into ceil(rows / rows_per_file) buckets by a row hash,
    and the data is repartitioned by (day, bucket): a day holding a third of
    the lake is written by many tasks, not one. The per-day row counts are a
    one-row-per-day aggregate. The days are replaced by renaming staged
    folders; if a day changes in the meantime, ``ConcurrentChange`` is raised and
    the day stays as it is. A lake kept by another sink's file log is refused:
    its log would still list the files that this removes. Returns files per day
    planned.
    """
    path = path.rstrip("/")
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is kept by a streaming file sink's log; only lakes without one can be compacted")
    finish_swap(spark, path)
    seen = observe(spark, path, [f"{partition_col}={d}" for d in dates])
    lake = spark.read.parquet(path)
    day_values = [F.lit(d).cast(lake.schema[partition_col].dataType) for d in dates]
    part = lake.filter(F.col(partition_col).isin(day_values))
    counts = {str(r[0]): r[1] for r in part.groupBy(partition_col).count().collect()}
    buckets = {d: max(1, math.ceil(n / rows_per_file)) for d, n in counts.items()}
    if not buckets:
        return {}
    levels = [partition_col, *([INGEST_COL] if INGEST_COL in lake.columns else [])]
    as_text = F.col(partition_col).cast("string")
    n_buckets = F.create_map(*[x for d, k in buckets.items() for x in (F.lit(d), F.lit(k))])
    row_hash = F.xxhash64(*[F.col(c) for c in part.columns if c not in levels])
    bucket = F.pmod(row_hash, n_buckets[as_text])
    dealt = part.repartition(sum(buckets.values()), F.col(partition_col), bucket)
    days = [f"{partition_col}={d}" for d in buckets]
    rewrite_days(spark, path, dealt, days, {d: seen[d] for d in days}, levels, rows_per_file)
    return buckets
