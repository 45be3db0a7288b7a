"""Readers for the benchmark tables and the adapter to the event model.

``events`` (event_id, ts, user_id, event_type, value, props) is mapped onto
the question-event envelope:

* question_id = event_id div 4 (each question observed four times),
* score = props.k, answer_count = k % 5, is_answered = true / false / null
  for k % 3 = 0 / 1 / other,
* region = the user's customer -> nation -> region name, ``UNKNOWN`` if none,
* timestamp text and creation_date from ``ts`` (UTC, whole seconds).

The region lookup is a left join on the customer key. No join carries a
broadcast hint: Spark's planner broadcasts a side only when its size estimate
is under ``spark.sql.autoBroadcastJoinThreshold`` (nation and region, 25 and
5 rows, always are), and adaptive execution re-checks with measured shuffle
sizes at run time; beyond the threshold the join stays a sort-merge join
whose skewed partitions adaptive execution splits (a user holding a third of
all events is cut into several tasks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.constants import (
    DEFAULT_REGION,
    ISO_OUTPUT_PATTERN,
    PAYLOAD_VERSION,
    QUESTION_LINK_PREFIX,
    QUESTION_TITLE_PREFIX,
    SOURCE_NAME,
)

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
)

OBSERVATIONS_PER_QUESTION = 4


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One benchmark table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, r_name): customer key to region name."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation_region = nation.join(
        region, nation.n_regionkey == region.r_regionkey
    ).select("n_nationkey", "r_name")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customer.join(
        nation_region,
        customer.c_nationkey == nation_region.n_nationkey,
        "left",
    ).select("c_custkey", "r_name")


def _k(props: Column) -> Column:
    return F.from_json(props, "k INT").getField("k")


def events_as_raw(spark: SparkSession, sf_dir: str, with_region: bool = True) -> DataFrame:
    """The ``events`` table as raw lake rows (envelope + event_time + event_date).

    ``with_region=False`` skips the customer lookup for callers that do not
    read ``region`` (it is then the default ``UNKNOWN``); the result is the
    same for every other column because the lookup is a left join on a
    unique key.
    """
    ev = read_table(spark, sf_dir, "events")
    region = F.lit(DEFAULT_REGION)
    if with_region:
        ev = ev.join(customer_regions(spark, sf_dir), ev.user_id == F.col("c_custkey"), "left")
        region = F.coalesce(F.col("r_name"), F.lit(DEFAULT_REGION))
    ts = F.col("ts").cast("timestamp")
    qid = F.expr(f"event_id div {OBSERVATIONS_PER_QUESTION}")
    k = _k(F.col("props"))
    payload = F.struct(
        qid.alias("question_id"),
        F.unix_seconds(ts).alias("creation_date"),
        F.concat(F.lit(QUESTION_TITLE_PREFIX), qid.cast("string")).alias("title"),
        k.alias("score"),
        (k % 5).alias("answer_count"),
        F.when(k % 3 == 0, F.lit(True)).when(k % 3 == 1, F.lit(False)).alias("is_answered"),
        F.concat(F.lit(QUESTION_LINK_PREFIX), qid.cast("string")).alias("link"),
    )
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type"),
        F.date_format(ts, ISO_OUTPUT_PATTERN).alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        region.alias("region"),
        F.lit(SOURCE_NAME).alias("source"),
        F.lit(PAYLOAD_VERSION).alias("payload_version"),
        payload.alias("payload"),
        F.timestamp_seconds(F.unix_seconds(ts)).alias("event_time"),
        F.to_date(ts).alias("event_date"),
    )


def events_as_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as question API items (the poller's input shape)."""
    raw = events_as_raw(spark, sf_dir, with_region=False)
    return raw.select(
        F.col("event_id").cast("long").alias("event_seq"),
        F.struct(
            F.col("payload.question_id").alias("question_id"),
            F.col("payload.creation_date").alias("creation_date"),
            F.col("payload.title").alias("title"),
            F.col("payload.score").alias("score"),
            F.col("payload.answer_count").alias("answer_count"),
            F.col("payload.is_answered").alias("is_answered"),
            F.col("payload.link").alias("link"),
            F.struct(F.col("user_id").cast("long").alias("user_id")).alias("owner"),
        ).alias("item"),
    )


def events_as_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Group consecutive items into landed API pages, one JSON text per page.

    A page holds at most ``page_size`` items by construction (event ids are
    unique), so the per-page ``collect_list`` is bounded.
    """
    items = events_as_items(spark, sf_dir)
    page_no = F.floor(F.col("event_seq") / F.lit(page_size)).alias("page_no")
    pages = items.groupBy(page_no).agg(
        F.sort_array(F.collect_list(F.struct("event_seq", "item"))).alias("entries")
    )
    page = F.struct(
        F.transform("entries", lambda e: e.getField("item")).alias("items"),
        F.lit(True).alias("has_more"),
        F.lit(None).cast("int").alias("backoff"),
        F.lit(None).cast("int").alias("quota_remaining"),
    )
    return pages.select("page_no", F.to_json(page).alias("value"))


__all__ = [
    "TABLES",
    "customer_regions",
    "events_as_items",
    "events_as_pages",
    "events_as_raw",
    "read_table",
]


def region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_date, region, event_count) straight from the table.

    Events are counted per day and user before they meet the customers, so the
    join sees one row per user and day and a hot user costs one row per task.
    """
    ev = read_table(spark, sf_dir, "events")
    counted = ev.groupBy(F.to_date(F.col("ts").cast("timestamp")).alias("event_date"), "user_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    named = counted.join(customer_regions(spark, sf_dir), counted.user_id == F.col("c_custkey"), "left")
    region = F.coalesce(F.col("r_name"), F.lit(DEFAULT_REGION)).alias("region")
    return named.groupBy("event_date", region).agg(F.sum("n").alias("event_count"))
