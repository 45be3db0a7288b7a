"""Windowed streaming aggregates and a stream-stream join, with explicit watermarks.

In append mode a window is emitted once, after the watermark passes its
end; rows older than the watermark are dropped. State is kept by Spark's
state store per window (and per key for the join) and is purged as the
watermark advances, so it stays bounded by the watermark delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_summary(
    stream: DataFrame,
    ts_col: str = "event_time",
    amount_col: str | None = None,
    window: str = "1 hour",
    watermark: str = "10 minutes",
    keys: list[str] | None = None,
) -> DataFrame:
    """(window_start, window_end, [keys], event_count[, total_value]) per tumbling window."""
    keys = keys or []
    aggs = [F.count(F.lit(1)).alias("event_count")]
    if amount_col:
        aggs.append(F.sum(F.col(amount_col).cast("decimal(18,2)")).cast("double").alias("total_value"))
    grouped = (
        stream.withWatermark(ts_col, watermark)
        .groupBy(F.window(F.col(ts_col), window).alias("w"), *keys)
        .agg(*aggs)
    )
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *keys,
        *[a for a in ("event_count", "total_value") if a in grouped.columns],
    )


def join_status_updates(
    orders: DataFrame,
    updates: DataFrame,
    key: str = "order_id",
    order_ts: str = "order_ts",
    update_ts: str = "update_ts",
    watermark: str = "1 hour",
    within: str = "30 minutes",
) -> DataFrame:
    """Inner join of two streams: each update to an order within ``within`` of it.

    Both sides carry a watermark and the join condition bounds the update
    time relative to the order time, which is what lets Spark drop old state.
    """
    o = orders.withWatermark(order_ts, watermark).alias("o")
    u = updates.withWatermark(update_ts, watermark).alias("u")
    cond = (
        (F.col(f"o.{key}") == F.col(f"u.{key}"))
        & (F.col(f"u.{update_ts}") >= F.col(f"o.{order_ts}"))
        & (F.col(f"u.{update_ts}") <= F.col(f"o.{order_ts}") + F.expr(f"INTERVAL {within}"))
    )
    return o.join(u, cond, "inner").select("o.*", *[F.col(f"u.{c}") for c in updates.columns if c != key])
