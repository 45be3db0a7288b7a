"""A lake that stays distinct as it is loaded: only the increment is compared.

Next to the lake lies an index of row digests, ``<path>._digests``, partitioned
like the lake by day and below that by load. A load

1. takes 128 bits of every incoming row's content (all columns but the batch
   level, which says where a row came from, not what it is) and keeps one row
   of each digest;
2. reads the digests of the days that it touches, and only those, and finds the
   ones that are there already. Incoming digests meet the index in a semi-join:
   when they are few Spark broadcasts them, and the index is scanned, not
   shuffled;
3. appends the other rows to the lake and their digests to the index, in
   folders named after the load;
4. writes the load's name into the index: a load that is repeated after that
   does nothing, one that is repeated before it replaces its own folders.

Run one load at a time, and repeat a failed one before the next. Rows with equal
digests count as equal (128 bits: with 1e12 rows the chance of one mistake is
about 1e-15).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.sinks.compaction import INGEST_COL
from strata.sinks.swap import path_exists, write_text

LOAD_COL = "_load"
DIGEST = ["_digest_1", "_digest_2"]


def digest_index(path: str) -> str:
    return path.rstrip("/") + "._digests"


def row_digest(columns: Iterable[str]) -> list[Column]:
    """Two 64-bit hashes of a row's content with its column names; nulls count."""
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return [F.xxhash64(F.lit(seed), content).alias(name) for seed, name in enumerate(DIGEST)]


def known_digests(spark: SparkSession, path: str, days: list, day: StructField, but_load: str) -> DataFrame | None:
    """Digests of the given days from other loads; other days' folders are not read. ``day``: the partition column."""
    index = digest_index(path)
    if not path_exists(spark, index):
        return None
    touched = F.col(day.name).isin([d for d in days if d is not None])
    if None in days:
        touched = F.coalesce(touched, F.lit(False)) | F.col(day.name).isNull()
    schema = StructType([*[StructField(c, LongType()) for c in DIGEST], day, StructField(LOAD_COL, StringType())])
    return spark.read.schema(schema).parquet(index).filter(touched & (F.col(LOAD_COL) != but_load)).select(*DIGEST)


def append_distinct(
    spark: SparkSession, path: str, rows: DataFrame, load: str, partition_col: str = "event_date"
) -> None:
    """Append the rows of an increment that the lake at ``path`` doesn't hold yet; ``load`` names the increment."""
    index = digest_index(path)
    done = f"{index}/_loads/{quote(load, safe='')}"
    if path_exists(spark, done):
        return
    content = [c for c in rows.columns if c != INGEST_COL]
    marked = rows.select(*[F.col(f"`{c}`") for c in content], *row_digest(content)).dropDuplicates(DIGEST)
    marked = marked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = [r[0] for r in marked.select(partition_col).distinct().collect()]
        known = known_digests(spark, path, days, rows.schema[partition_col], load)
        fresh = marked
        if known is not None:
            there = known.join(marked.select(*DIGEST), DIGEST, "left_semi")
            fresh = marked.join(there, DIGEST, "left_anti")
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write(fresh.select(*content, F.lit(load).alias(INGEST_COL)), path, partition_col, INGEST_COL)
            _write(fresh.select(partition_col, *DIGEST, F.lit(load).alias(LOAD_COL)), index, partition_col, LOAD_COL)
        finally:
            fresh.unpersist()
    finally:
        marked.unpersist()
    write_text(spark, done, "")


def _write(df: DataFrame, path: str, *levels: str) -> None:
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*levels).parquet(path)


def distinct_batches(spark: SparkSession, path: str, name: str, partition_col: str = "event_date") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads every micro-batch this way; ``name`` must be the stream's own."""

    def run(batch: DataFrame, epoch: int) -> None:
        append_distinct(spark, path, batch, f"{name}-epoch{epoch}", partition_col)

    return run
