"""A stored type-2 dimension: current versions in buckets, history in append-only folders.

``current/<n>/_bucket=k`` holds the open versions of the keys of bucket k,
``history/<n>`` the versions that snapshot n closed. A snapshot

1. brings the current and the snapshot's version of every key together: one
   aggregate over both (never over history), kept while the snapshot is applied,
   so the snapshot's frame is evaluated once;
2. writes the closed versions of changed keys to a new history folder, and the
   buckets that hold a changed or new key to new folders, few files each;
3. switches the pointer (``strata.sinks.versions``).

Untouched buckets and all earlier history stay as they are. ``read_dimension``
merges the live folders. The rules are those of ``operators.model.scd2_apply``:
a null key is a key, of several snapshot rows of one key the largest by the
tracked columns counts, keys missing from a snapshot stay open unless
``close_missing``. A snapshot that is applied again changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from strata.sinks.swap import child_names
from strata.sinks.versions import commit, forget, latest

BUCKET = "_bucket"
BUCKETS = 64


#: Types that are compared as they are; values of all others by their JSON text.
_PLAIN = (BooleanType, ByteType, ShortType, IntegerType, LongType, DecimalType, DateType, StringType, BinaryType)


def _differs(old: str, new: str, fields: list[StructField]) -> Column:
    """Whether the tracked values of two structs differ; a missing struct differs from any other."""
    differs = F.col(old).isNull() != F.col(new).isNull()
    for field in fields:
        pair = [F.col(side).getField(field.name) for side in (old, new)]
        if not isinstance(field.dataType, _PLAIN):
            pair = [F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}) for c in pair]
        differs = differs | ~pair[0].eqNullSafe(pair[1])
    return differs


def _current(spark: SparkSession, path: str, state: dict) -> DataFrame | None:
    folders = [f"{path}/{f}" for f in state.get("current", {}).values()]
    if not folders:
        return None
    return spark.read.schema(StructType.fromDDL(state["schema"])).parquet(*folders)


def _folders(content: dict) -> list[str]:
    return [*content.get("current", {}).values(), *content.get("history", [])]


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """All versions: keys, tracked columns, valid_from, valid_to (null while open), is_current."""
    path = path.rstrip("/")
    version, state = latest(spark, path)
    if not version:
        raise FileNotFoundError(path)
    schema = StructType.fromDDL(state["schema"])
    closed = StructType(schema.fields).add("valid_to", "date")
    parts = []
    current = _current(spark, path, state)
    if current is not None:
        parts.append(current.select("*", F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current")))
    if state["history"]:
        history = spark.read.schema(closed).parquet(*[f"{path}/{f}" for f in state["history"]])
        parts.append(history.select("*", F.lit(False).alias("is_current")))
    if not parts:
        return spark.createDataFrame([], closed.add("is_current", "boolean"))
    return reduce(DataFrame.unionByName, parts)


def apply_snapshot(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: str | Iterable[str],
    tracked: Iterable[str],
    effective_date: str,
    close_missing: bool = False,
    buckets: int = BUCKETS,
) -> int:
    """Apply a snapshot to the dimension at ``path`` (created by the first one); returns the live version.

    ``buckets`` counts for a new dimension only. Raises ``ConcurrentChange`` if
    another snapshot was committed meanwhile.
    """
    path = path.rstrip("/")
    keys, tracked = [keys] if isinstance(keys, str) else list(keys), list(tracked)
    base, state = latest(spark, path)
    if not state:
        row = incoming.select(*keys, *tracked, F.lit(None).cast("date").alias("valid_from"))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in row.schema.fields)
        state = {"schema": fields, "buckets": buckets, "current": {}, "history": []}
    bucket = F.pmod(F.xxhash64(*keys), F.lit(state["buckets"])).cast("int")
    schema = StructType.fromDDL(state["schema"])
    current = _current(spark, path, state)

    # Of several snapshot rows of one key the largest counts; a key has one open version.
    versions = [*tracked, "valid_from"]
    arrived = F.struct(*[F.col(f"`{c}`") for c in tracked])
    held = F.struct(*[F.col(f"`{c}`") for c in versions])
    nothing = F.lit(None).cast(StructType([schema[c] for c in versions]))
    sides = incoming.select(*keys, arrived.alias("_new"), nothing.alias("_old"))
    if current is not None:
        none = F.lit(None).cast(StructType([schema[c] for c in tracked]))
        sides = sides.unionByName(current.select(*keys, none.alias("_new"), held.alias("_old")))
    both = sides.groupBy(*keys).agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    differs = _differs("_old", "_new", [schema[c] for c in tracked])
    if not close_missing:
        differs = differs & F.col("_new").isNotNull()
    both = both.withColumns({"_changed": differs, BUCKET: bucket}).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = sorted(r[0] for r in both.filter("_changed").select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            return base
        number = base + 1
        effective = F.lit(effective_date).cast("date")
        history = list(state["history"])
        if any(int(k) in touched for k in state["current"]):
            closed = both.filter("_changed AND _old IS NOT NULL").select(*keys, "_old.*", effective.alias("valid_to"))
            closed.write.mode("overwrite").parquet(f"{path}/history/{number}")
            history.append(f"history/{number}")
        opened = F.when(F.col("_new").isNotNull(), F.struct("_new.*", effective.alias("valid_from")))
        live = F.when(F.col("_changed"), opened).otherwise(F.col("_old"))
        rows = both.filter(F.col(BUCKET).isin(touched)).select(*keys, live.alias("_live"), BUCKET).filter("_live IS NOT NULL")
        out = f"{path}/current/{number}"
        rows = rows.select(*keys, "_live.*", BUCKET).hint("rebalance", BUCKET)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(out)
    finally:
        both.unpersist()
    written = {n.partition("=")[2]: f"current/{number}/{n}" for n in child_names(spark, out)}
    kept = {k: f for k, f in state["current"].items() if int(k) not in touched}
    return commit(spark, path, base, {**state, "current": kept | written, "history": history})


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the newest ``keep`` versions uses (readers may still read those)."""
    return forget(spark, path.rstrip("/"), keep, _folders)
