"""Join of two streams whose rows come in any order, with late rows kept.

A row of the right side matches the rows of the left side with its key whose
time is at most ``within`` before its own. Per micro-batch the new rows of both
sides meet each other and the rows seen before; what they match is stored as
the batch's pairs. The rows seen before are the state: two tables in folders by
period of event time (``unit``: a day, or a month or year where a batch spans
many days) and, below, by batch. A batch reads only the periods that its times
can match, and appends its own rows; nothing is rewritten.

The clock is the largest event time of all batches before. A row more than
``lateness`` behind it (or without key or time) is late: it goes to the late
table with its batch, whole, and doesn't take part. State periods that no row in
time can match any more are deleted. So every pair of two rows in time is found
once, whatever their order, and

    pairs + (late left rows with all right rows) + (left rows in time with late right rows)

is the join of all rows. The state is bounded by ``lateness`` + ``within`` of
event time; a hot key is an ordinary skewed join of one batch.

Each batch writes into folders of its own number, from the clock that the batch
before it stored, so a replayed batch stores the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from strata.sinks.swap import _fs, delete_path, partition_folders, path_exists, read_text, write_text

_PERIOD, _EPOCH = "_period", "_epoch"


def both_sides(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str) -> DataFrame:
    """Two frames (or streams) as one: key, ts, and the row as ``l`` or ``r``."""
    null = {s: F.lit(None).cast(StructType(df.schema.fields)).alias(s) for s, df in (("l", left), ("r", right))}

    def side(df: DataFrame, name: str, ts: str) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
        sides = [row if s == name else null[s] for s in ("l", "r")]
        return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ts}`").cast("timestamp").alias("ts"), *sides)

    return side(left, "l", left_ts).unionByName(side(right, "r", right_ts))


def match(left: DataFrame, right: DataFrame, within: str) -> DataFrame:
    """(l, r) of all rows (key, ts, l) and (key, ts, r) that match."""
    a, b = left.alias("a"), right.alias("b")
    in_time = (F.col("b.ts") >= F.col("a.ts")) & (F.col("b.ts") <= F.col("a.ts") + F.expr(f"INTERVAL {within}"))
    return a.join(b, (F.col("a.key") == F.col("b.key")) & in_time).select("a.l", "b.r")


def _clock(spark: SparkSession, path: str, epoch: int) -> int | None:
    """Microseconds of the newest event time in batches before this one."""
    fs, p = _fs(spark, f"{path}/clock")
    if not fs.exists(p):
        return None
    before = [int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()]
    before = [n for n in before if n < epoch]
    return int(read_text(spark, f"{path}/clock/{max(before)}")) if before else None


def any_order_batch(spark: SparkSession, path: str, within: str, lateness: str, unit: str = "day") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream made by ``both_sides``; tables below ``path``."""
    path = path.rstrip("/")

    def period(ts: Column) -> Column:
        return F.to_date(F.date_trunc(unit, ts))

    def state(side: str, schema: StructType, epoch: int, first: Column, last: Column) -> DataFrame | None:
        folder = f"{path}/state/{side}"
        if not path_exists(spark, folder):
            return None
        full = StructType([*schema.fields, StructField(_PERIOD, DateType()), StructField(_EPOCH, IntegerType())])
        stored = spark.read.schema(full).parquet(folder)
        return stored.filter((F.col(_PERIOD) >= first) & (F.col(_PERIOD) <= last) & (F.col(_EPOCH) < epoch)).select(*schema.names)

    def store(rows: DataFrame, table: str, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{table}/{_EPOCH}={epoch}")

    def evict(side: str, before) -> None:
        """Delete the state of periods before this one (a date or None)."""
        folder = f"{path}/state/{side}"
        if before is not None and path_exists(spark, folder):
            for day, name in partition_folders(spark, folder, _PERIOD).items():
                if day is not None and day < str(before):
                    delete_path(spark, f"{folder}/{name}")

    def run(batch: DataFrame, epoch: int) -> None:
        now = _clock(spark, path, epoch)
        limit = F.timestamp_micros(F.lit(now).cast("bigint")) - F.expr(f"INTERVAL {lateness}")
        batch = batch.withColumn("_in_time", F.col("key").isNotNull() & F.col("ts").isNotNull())
        if now is not None:
            batch = batch.withColumn("_in_time", F.col("_in_time") & (F.col("ts") >= limit))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok, is_left = F.col("_in_time"), F.col("l").isNotNull()
            left_ts, right_ts = F.when(ok & is_left, F.col("ts")), F.when(ok & ~is_left, F.col("ts"))
            span = F.expr(f"INTERVAL {within}")
            times = batch.agg(
                F.unix_micros(F.max(F.when(F.col("key").isNotNull(), F.col("ts")))).alias("newest"),
                period(F.min(left_ts)).alias("l_first"),
                period(F.max(left_ts) + span).alias("l_last"),
                period(F.min(right_ts) - span).alias("r_first"),
                period(F.max(right_ts)).alias("r_last"),
                F.max(period(limit)).alias("limit"),
                F.max(period(limit - span)).alias("limit_left"),
            ).first()
            store(batch.filter(~ok).select("key", "ts", "l", "r"), "late", epoch)
            fresh = {s: batch.filter(ok & F.col(s).isNotNull()).select("key", "ts", s) for s in ("l", "r")}
            pairs = match(fresh["l"], fresh["r"], within)
            if times["r_first"] is not None:
                seen = state("l", fresh["l"].schema, epoch, F.lit(times["r_first"]), F.lit(times["r_last"]))
                pairs = pairs if seen is None else pairs.unionByName(match(seen, fresh["r"], within))
            if times["l_first"] is not None:
                seen = state("r", fresh["r"].schema, epoch, F.lit(times["l_first"]), F.lit(times["l_last"]))
                pairs = pairs if seen is None else pairs.unionByName(match(fresh["l"], seen, within))
            store(pairs, "pairs", epoch)
            for side, rows in fresh.items():
                dated = rows.withColumns({_PERIOD: period(F.col("ts")), _EPOCH: F.lit(epoch)})
                w = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                w.partitionBy(_PERIOD, _EPOCH).parquet(f"{path}/state/{side}")
            # From the clock before this batch, which a replay sees again.
            evict("l", times["limit_left"])
            evict("r", times["limit"])
            newest = max((t for t in (now, times["newest"]) if t is not None), default=None)
            if newest is not None:
                write_text(spark, f"{path}/clock/{epoch}", str(newest))
        finally:
            batch.unpersist()

    return run


def start_any_order_join(
    left: DataFrame,
    right: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    left_ts: str,
    right_ts: str,
    within: str,
    lateness: str,
    interval: str | None = None,
    unit: str = "day",
) -> StreamingQuery:
    """Join two streams into tables below ``path``; drains what is there, or runs every ``interval``."""
    rows = both_sides(left, right, key, left_ts, right_ts)
    w = rows.writeStream.foreachBatch(any_order_batch(rows.sparkSession, path, within, lateness, unit))
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)
    return w.start()


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(l, r): all pairs found so far."""
    return spark.read.parquet(f"{path.rstrip('/')}/pairs").select("l", "r")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """(key, ts, l, r): the rows that came too late, or have no key or time."""
    return spark.read.parquet(f"{path.rstrip('/')}/late").select("key", "ts", "l", "r")


def late_pairs(late: DataFrame, left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str) -> DataFrame:
    """The pairs that ``read_late`` rows have with all rows: what a repair run adds to the pairs."""
    rows = both_sides(left, right, key, left_ts, right_ts)
    late_l, late_r = (late.filter(F.col(s).isNotNull()).select("key", "ts", s) for s in ("l", "r"))
    all_l, all_r = (rows.filter(F.col(s).isNotNull()).select("key", "ts", s) for s in ("l", "r"))
    # Left rows in time: every left row but the late ones (rows that repeat count as often).
    in_time = all_l.exceptAll(late_l)
    return match(late_l, all_r, within).unionByName(match(in_time, late_r, within))
