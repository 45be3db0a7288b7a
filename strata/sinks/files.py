"""Writers: outputs, text tuples, catalog tables, staged self-overwrite, bucketing.

Spark's Parquet tables have no MERGE and no transactional replace, and an
overwrite of a path that the same plan reads deletes the input before it is
read. Every rewrite of a table from itself therefore goes through a staging
location next to the target (same file system, shared storage), never a
machine-local folder.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.compaction import INGEST_COL, rewrite_days
from strata.sinks.swap import child_names, finish_swap, observe, partition_levels, path_exists, replace

LAYERS = ("bronze", "silver", "gold")


def write_output(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: str | Iterable[str] | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """Write a result; ``overwrite`` works on any file system (no local delete)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def score_totals_as_text(totals: DataFrame) -> DataFrame:
    """(question_id, total) -> one ``(id, total)`` tuple text per row."""
    return totals.select(
        F.format_string("(%d, %d)", F.col("question_id"), F.col("total")).alias("value")
    )


def write_score_totals_text(totals: DataFrame, path: str) -> None:
    """Text sink of the score totals, one tuple per line (overwrite)."""
    score_totals_as_text(totals).write.mode("overwrite").text(path)


def overwrite_via_staging(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | Iterable[str] | None = None,
    seen: dict | None = None,
) -> DataFrame:
    """Overwrite ``path`` with ``df`` even when ``df`` reads ``path``; returns a frame over the new target.

    The data is written once, next to the target, and renamed into place. If
    ``df`` reads ``path``, pass ``seen = observe(spark, path)`` taken before
    ``df`` was made: rows that land in between then raise ``ConcurrentChange``.
    """
    replace(spark, path, lambda folder: write_output(df, folder, fmt=fmt, partition_by=partition_by), seen=seen)
    return spark.read.format(fmt).load(path)


def dedupe_path(spark: SparkSession, path: str, fmt: str = "parquet", partition_by=None) -> DataFrame:
    """Distinct rows of a stored table, written back over itself safely; returns the new table.

    Rows are compared in all columns but the batch level of an ingested lake,
    which says where a row came from, not what it is; such a lake keeps its
    layout and its marks. Partition columns are read off the folders unless
    given. An earlier run that stopped inside its swap is completed first. This
    compares all rows; ``sinks.distinct`` keeps a lake distinct as it grows.
    """
    finish_swap(spark, path)
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    levels = partition_levels(spark, path) if partition_by is None else partition_by
    levels = [levels] if isinstance(levels, str) else list(levels)
    if INGEST_COL in levels and fmt == "parquet":
        days = [n for n in child_names(spark, path) if "=" in n]
        seen = observe(spark, path, days)
        rows = spark.read.parquet(path)
        kept = rows.drop(INGEST_COL).distinct()
        rewrite_days(spark, path, kept, days, seen, levels)
        return spark.read.schema(rows.schema).parquet(path)
    seen = observe(spark, path)
    kept = spark.read.format(fmt).load(path).distinct()
    return overwrite_via_staging(spark, kept, path, fmt, levels, seen)


def ensure_layers(spark: SparkSession, layers: Iterable[str] = LAYERS, location: str | None = None) -> None:
    """Create the layer databases if absent, below ``location`` if given (else in the warehouse)."""
    for layer in layers:
        at = "" if location is None else " LOCATION '" + f"{location.rstrip('/')}/{layer}".replace("'", "\\'") + "'"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{at}")


def _reads_table(df: DataFrame, name: str) -> bool:
    """Whether the frame reads any file of the table."""
    own = set(df.sparkSession.table(name).inputFiles())
    return not own.isdisjoint(df.inputFiles())


def replace_table(spark: SparkSession, df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """Create or replace a catalog table from ``df`` (which may read the table).

    The session catalog rejects ``CREATE OR REPLACE TABLE AS`` and a table
    overwrite from itself, so when the plan reads the table the result is
    first saved as ``<name>__staging`` and the target replaced from that;
    otherwise it is written once.
    """
    w_opts = {"partitionBy": partition_by} if partition_by else {}
    if not spark.catalog.tableExists(name) or not _reads_table(df, name):
        df.write.mode("overwrite").saveAsTable(name, **w_opts)
        return spark.table(name)
    stage = f"{name}__staging"
    df.write.mode("overwrite").saveAsTable(stage, **w_opts)
    spark.table(stage).write.mode("overwrite").saveAsTable(name, **w_opts)
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    return spark.table(name)


def write_bucketed(
    df: DataFrame,
    name: str,
    buckets: int,
    bucket_by: str | Iterable[str],
    sort_by: str | Iterable[str] | None = None,
    partition_by: str | Iterable[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Save a table bucketed (and optionally sorted / partitioned), below ``path`` if given.

    Two tables bucketed on the join key with the same bucket count join
    without a shuffle on either side.
    """
    cols = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *cols)
    if sort_by:
        w = w.sortBy(*([sort_by] if isinstance(sort_by, str) else sort_by))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def create_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Register each frame as a temporary view for SQL inspection."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def clone_database(spark: SparkSession, source: str, target: str, location: str | None = None) -> list[str]:
    """Deep copy every table of ``source`` into ``target`` (no zero-copy clone here).

    The loop is over table names from the catalog; each copy is a distributed
    read and write.
    """
    ensure_layers(spark, [target], location)
    copied = []
    for t in spark.catalog.listTables(source):
        if t.isTemporary:
            continue
        spark.table(f"{source}.{t.name}").write.mode("overwrite").saveAsTable(f"{target}.{t.name}")
        copied.append(t.name)
    return copied
