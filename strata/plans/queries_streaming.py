"""Registered queries that run as Structured Streaming jobs over the tables.

Each query streams a table's Parquet file through the operator with an
``availableNow`` trigger into a Parquet sink under the session's shared
checkpoint folder, then returns the stored result. With one input file the
stream sees one data batch, so the result is exactly defined: the windowed
aggregate emits the windows closed by the final watermark, the join emits
every pair inside its time bound.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import metrics, model
from strata.plans.catalog import register
from strata.plans.oracle import with_raw
from strata.session import checkpoint_root
from strata.sinks.files import score_totals_as_text
from strata.sinks.swap import is_folder
from strata.sources.driver_tables import events_as_raw, read_table
from strata.sources.lake import parse_score_totals_text
from strata.streaming.upsert import start_apply_changes
from strata.streaming.windows import join_status_updates, windowed_summary


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Reading the schema fails if there is no such table. A file stream source
    # watches a folder: the table's own, or for a table of one file the one it is in.
    schema = read_table(spark, sf_dir, name).schema
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir.rstrip("/"))


def _run_to_parquet(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    base = os.path.join(checkpoint_root(spark), "streams", f"{tag}-{uuid.uuid4().hex}")
    q = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", os.path.join(base, "out"))
        .option("checkpointLocation", os.path.join(base, "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(os.path.join(base, "out"))


@register(
    "stream_hourly_windows",
    """WITH h AS (
    SELECT date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           COUNT(*) AS event_count,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM events GROUP BY 1, 2)
SELECT * FROM h WHERE window_end <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def q_stream_hourly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Watermarks need instants: zone-less times are read as UTC instants and
    # the window bounds converted back for output.
    stream = _table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    agg = windowed_summary(stream, ts_col="ts", amount_col="value", window="1 hour", watermark="10 minutes")
    out = _run_to_parquet(spark, agg, "hourly")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register(
    "stream_order_line_join",
    """SELECT o.o_orderkey AS order_id, o.o_orderdate AS order_ts, l.l_linenumber,
       l.l_shipdate AS update_ts, l.l_linestatus AS status
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_shipdate >= o.o_orderdate AND l.l_shipdate <= o.o_orderdate + INTERVAL 121 DAY""",
)
def q_stream_order_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table_stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("order_ts")
    )
    lines = _table_stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        F.col("l_shipdate").cast("timestamp").alias("update_ts"),
        F.col("l_linestatus").alias("status"),
    )
    joined = join_status_updates(orders, lines, watermark="1 day", within="121 days")
    out = _run_to_parquet(spark, joined, "orderjoin")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("order_ts", "update_ts")})


@register(
    "order_status_upsert",
    """WITH derived AS (
    SELECT l_orderkey AS o_orderkey,
           CASE WHEN COUNT(*) FILTER (WHERE l_linestatus = 'F') = COUNT(*) THEN 'F'
                WHEN COUNT(*) FILTER (WHERE l_linestatus = 'O') = COUNT(*) THEN 'O'
                ELSE 'P' END AS o_orderstatus
    FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS order_id, COALESCE(d.o_orderstatus, o.o_orderstatus) AS status,
       CAST(o.o_orderdate AS DATE) AS order_date
FROM orders o LEFT JOIN derived d ON o.o_orderkey = d.o_orderkey""",
)
def q_order_status_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a keyed target; status changes derived from line items are
    streamed through the ``foreachBatch`` upsert (month partitions)."""
    base = os.path.join(checkpoint_root(spark), "streams", f"upsert-{uuid.uuid4().hex}")
    orders = read_table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("order_month")
    initial = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("order_date"),
        month,
        F.lit(0).alias("version"),
    )
    initial.write.partitionBy("order_month").parquet(os.path.join(base, "target"))
    derived = model.derived_order_status(read_table(spark, sf_dir, "lineitem"))
    changes = derived.join(orders.select("o_orderkey", "o_orderdate"), "o_orderkey").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("order_date"),
        month,
        F.lit(1).alias("version"),
        F.lit(False).alias("_deleted"),
    )
    changes.write.parquet(os.path.join(base, "changes"))
    stream = spark.readStream.schema(changes.schema).parquet(os.path.join(base, "changes"))
    q = start_apply_changes(
        spark, stream, os.path.join(base, "target"), os.path.join(base, "ckpt"),
        keys=["order_id"], order_by=["version"], partition_col="order_month", delete_col="_deleted",
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(os.path.join(base, "target")).select("order_id", "status", "order_date")


# --- batch variants of the reference outputs ---------------------------------------

TOTALS_SQL = """SELECT question_id, CAST(SUM(COALESCE(score, 0)) AS BIGINT) AS total
FROM raw WHERE question_id IS NOT NULL GROUP BY question_id"""


def _raw_sql(body: str) -> str:
    return with_raw(body)


@register("score_totals_text_roundtrip", _raw_sql(TOTALS_SQL))
def q_score_totals_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals -> ``(id, total)`` text lines -> parsed back (no eval)."""
    totals = metrics.question_score_totals(events_as_raw(spark, sf_dir, with_region=False))
    return parse_score_totals_text(score_totals_as_text(totals))


@register(
    "top_score_totals",
    _raw_sql(f"SELECT * FROM ({TOTALS_SQL}) t ORDER BY total DESC, question_id ASC LIMIT 20"),
)
def q_top_score_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = metrics.question_score_totals(events_as_raw(spark, sf_dir, with_region=False))
    return metrics.top_score_totals(totals, 20)


@register(
    "top_questions_distinct_daily",
    with_raw(
        """SELECT event_date, question_id, title, score, answer_count FROM best
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY score DESC NULLS LAST, event_id ASC) <= 10""",
        """r AS (SELECT CAST(event_time AS DATE) AS event_date, event_id, question_id, title, score, answer_count
      FROM raw)""",
        """best AS (SELECT * FROM r
         QUALIFY ROW_NUMBER() OVER (PARTITION BY event_date, question_id
                                    ORDER BY score DESC NULLS LAST, event_id ASC) = 1)""",
    ),
)
def q_top_questions_distinct_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events_as_raw(spark, sf_dir, with_region=False)
    return metrics.top_questions_daily(raw, k=10, distinct_questions=True)


@register(
    "events_by_type_partition_date",
    _raw_sql("SELECT event_date, event_type, COUNT(*) AS event_count FROM raw GROUP BY 1, 2"),
)
def q_events_by_type_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events_as_raw(spark, sf_dir, with_region=False)
    return metrics.events_by_type_daily(raw, use_partition_date=True)
