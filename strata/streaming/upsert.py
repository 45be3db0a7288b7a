"""Periodic apply of captured changes into a keyed, date-partitioned table.

Each micro-batch (from ``foreachBatch``) is merged with only the target
partitions it touches, and those partitions are replaced by renaming staged
folders. The latest row per key wins, whether it comes from the batch or the
target, so a late or replayed change does no harm and the sink is effectively
exactly-once. Deleted keys leave their version in a deletion log next to the
target, so an older change that arrives later doesn't bring them back. Parquet
has no MERGE; this is the rewrite form of an upsert.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType, TimestampType, VariantType

from strata.sinks.swap import ConcurrentChange, finish_swap, observe, partition_folders, path_exists, replace

DELETE_FLAG = "_deleted"
LOGGED_AT = "_logged_at"


def _has_order(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return _has_order(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def latest_per_key(changes: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the last by ``order_by``, ties broken by all other (orderable) columns.

    Null keys are one key. Rows of a key are combined before the shuffle: by an
    aggregate that sorts by the keys only, or, where a column has no order, by
    a window with a group limit.
    """
    unordered = [f.name for f in changes.schema.fields if not _has_order(f.dataType)]
    first = list(dict.fromkeys(c for c in order_by if c not in keys))
    rest = [c for c in changes.columns if c not in keys and c not in first and c not in unordered]
    if keys and not unordered and (first or rest):
        # The struct's order, nulls lowest, is that of the window below.
        row = F.max(F.struct(*[F.col(f"`{c}`") for c in [*first, *rest]])).alias("_row")
        latest = changes.groupBy(*keys).agg(row)
        whole = {c: F.col("_row").getField(c) for c in [*first, *rest]}
        return latest.select(*[whole[c].alias(c) if c in whole else F.col(c) for c in changes.columns])
    order = [F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return changes.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def deletion_log(target_path: str) -> str:
    """Where the deletions of a target are kept: next to it, on the same storage."""
    return target_path.rstrip("/") + "._deletions"


def merge_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    delete_col: str | None = None,
    deletions: DataFrame | None = None,
) -> DataFrame:
    """The latest row per key of target and changes together; deleted keys are left out.

    A change that is older than the target's row by ``order_by`` is ignored; at
    the same version the change wins. ``deletions`` (keys and ``order_by``) are
    versions like any other, so a change that is older than its key's deletion
    doesn't bring the key back; at the same version a row that is there wins
    over a logged deletion. Without them a deleted key keeps no version.
    """
    flag = F.coalesce(F.col(delete_col), F.lit(False)) if delete_col else F.lit(False)
    plain = [c for c in changes.columns if c != delete_col]
    rows = changes.select(*plain, flag.alias("_gone"), F.lit(1).alias("_change"))
    if target is not None:
        rows = rows.unionByName(target.select(*plain, F.lit(False).alias("_gone"), F.lit(0).alias("_change")))
    if deletions is not None:
        known = deletions.select(*keys, *order_by, F.lit(True).alias("_gone"), F.lit(-1).alias("_change"))
        rows = rows.unionByName(known, allowMissingColumns=True)
    return latest_per_key(rows, keys, [*order_by, "_change"]).filter("NOT _gone").select(*plain)


def _read_deletions(spark: SparkSession, target_path: str, schema: StructType) -> DataFrame | None:
    path = deletion_log(target_path)
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def _log_schema(like: StructType, keys: list[str], order_by: list[str]) -> StructType:
    fields = [like[c] for c in dict.fromkeys([*keys, *order_by])]
    return StructType([*fields, StructField(LOGGED_AT, TimestampType())])


def compact_deletions(
    spark: SparkSession, target_path: str, keys: Iterable[str], order_by: Iterable[str], keep_since: datetime | None = None
) -> DataFrame | None:
    """Rewrite the deletion log with one row per key, its latest deletion.

    ``keep_since``: forget deletions logged before; a change that is older than
    such a deletion and arrives after that brings its key back. Returns the log.
    """
    path, keys, order_by = deletion_log(target_path), list(keys), list(order_by)
    finish_swap(spark, path)
    if not path_exists(spark, path):
        return None
    seen = observe(spark, path)
    log = spark.read.parquet(path)
    kept = latest_per_key(log, keys, order_by)
    if keep_since is not None:
        kept = kept.filter(F.col(LOGGED_AT) >= F.lit(keep_since))
    replace(spark, path, lambda folder: kept.write.parquet(folder), seen=seen)
    return spark.read.schema(log.schema).parquet(path)


def apply_changes_batch(
    spark: SparkSession,
    target_path: str,
    keys: Iterable[str],
    order_by: Iterable[str],
    partition_col: str,
    delete_col: str | None = None,
    keys_move: bool = True,
    max_partitions: int = 10_000,
    attempts: int = 3,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function applying each batch to ``target_path``.

    Only target partitions that hold a partition value of the batch are read
    and rewritten; null is a value like any other. A key may change its
    partition: the partitions that hold the batch's keys now are found by a scan
    of the key columns of the target's other partitions and rewritten too
    (``keys_move=False`` saves the scan where keys never move). The partition column must be coarse: a batch
    that touches more than ``max_partitions`` values is an error.

    Deletions are appended to the deletion log before the target changes, with
    their versions, and the log's entries for the batch's keys take part in
    every merge. A replayed batch logs them again, which changes nothing.

    If another writer changes a touched partition meanwhile, the batch is merged
    anew, up to ``attempts`` times; then ``ConcurrentChange`` ends the stream
    with the batch uncommitted.
    """
    keys, order_by = list(keys), list(order_by)

    def same(left: str, right: str) -> list[Column]:
        return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if delete_col:
                gone = batch.filter(F.coalesce(F.col(delete_col), F.lit(False)))
                if not gone.isEmpty():
                    log = latest_per_key(gone.select(*dict.fromkeys([*keys, *order_by])), keys, order_by)
                    log.withColumn(LOGGED_AT, F.current_timestamp()).write.mode("append").parquet(deletion_log(target_path))
            for attempt in range(1, attempts + 1):
                try:
                    return merge(batch)
                except ConcurrentChange:
                    if attempt == attempts:
                        raise
        finally:
            batch.unpersist()

    def merge(batch: DataFrame) -> None:
        finish_swap(spark, target_path)
        # Read with the change schema so partition values keep their type.
        schema = StructType([f for f in batch.schema.fields if f.name != delete_col])
        exists = path_exists(spark, target_path)
        wanted = batch.select(*keys).distinct().alias("b")

        def parts_of(rows: DataFrame) -> list[tuple]:
            found = rows.select(partition_col).distinct().select(partition_col, F.col(partition_col).cast("string").alias("name"))
            return [(r[0], r[1]) for r in found.limit(max_partitions + 1).collect()]

        def within(parts: list[tuple]) -> Column:
            inside = F.coalesce(F.col(partition_col).isin([p for p, _ in parts if p is not None]), F.lit(False))
            return inside | F.col(partition_col).isNull() if any(p is None for p, _ in parts) else inside

        parts = parts_of(batch)
        folders = partition_folders(spark, target_path, partition_col) if exists else {}
        # The batch's own partitions are read anyway: only the others are searched for its keys.
        if keys_move and folders.keys() - {name for _, name in parts}:
            others = spark.read.schema(schema).parquet(target_path).filter(~within(parts)).alias("t")
            parts += parts_of(others.join(wanted, same("t", "b"), "left_semi").select(f"t.{partition_col}"))
        if len(parts) > max_partitions:
            raise ValueError(f"a batch touches more than {max_partitions} values of {partition_col}")
        if not parts:
            return
        target, seen = None, {}
        if exists:
            seen = observe(spark, target_path, [folders[name] for _, name in parts if name in folders])
            target = spark.read.schema(schema).parquet(target_path).filter(within(parts))
        deletions = _read_deletions(spark, target_path, _log_schema(batch.schema, keys, order_by))
        if deletions is not None:
            deletions = deletions.alias("d").join(wanted, same("d", "b"), "left_semi")
        merged = merge_changes(target, batch, keys, order_by, delete_col, deletions)

        def write(path: str) -> None:
            # rebalance: AQE groups rows by partition value (few files per
            # partition) and splits a hot partition across several writers.
            merged.hint("rebalance", partition_col).write.partitionBy(partition_col).parquet(path)

        replace(spark, target_path, write, names=seen, seen=seen)

    return run


def start_apply_changes(
    spark: SparkSession,
    changes: DataFrame,
    target_path: str,
    checkpoint: str,
    keys: Iterable[str],
    order_by: Iterable[str],
    partition_col: str,
    delete_col: str | None = None,
    trigger: str = "available_now",
    interval: str = "5 minutes",
    keys_move: bool = True,
) -> StreamingQuery:
    """Run ``apply_changes_batch`` on a change stream (every ``interval``, or drain once)."""
    fn = apply_changes_batch(spark, target_path, keys, order_by, partition_col, delete_col, keys_move)
    w = changes.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=interval)
    return w.start()
