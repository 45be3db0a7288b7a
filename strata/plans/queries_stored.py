"""Registered queries whose result is read back from storage: lakes, rewrites, text, CSV, increments."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import envelope, medallion, metrics, model, privacy, quality
from strata.plans.catalog import register
from strata.plans.jobs import run_daily_increment, run_daily_outputs
from strata.plans.oracle import with_raw
from strata.plans.queries_medallion import RAW_FLAT_SQL, flatten_raw
from strata.session import checkpoint_root
from strata.sinks import compact_partitions, dedupe_path, write_messages_text, write_score_totals_text
from strata.sources import lake
from strata.sources.driver_tables import events_as_raw, read_table
from strata.streaming.ingest import ingest
from strata.streaming.upsert import apply_changes_batch


def _folder(spark: SparkSession, tag: str) -> str:
    return os.path.join(checkpoint_root(spark), "stored", f"{tag}-{uuid.uuid4().hex}")


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Every event as a landed message, drained into a lake; the lake's path."""
    base = _folder(spark, "lake")
    write_messages_text(events_as_raw(spark, sf_dir), f"{base}/landing")
    ingest(spark, f"{base}/lake", f"{base}/ckpt", {"fmt": "files", "path": f"{base}/landing"})
    return f"{base}/lake"


def _days(raw: DataFrame) -> list[str]:
    """The lake's days (one short text each)."""
    return [str(r[0]) for r in raw.select("event_date").distinct().orderBy("event_date").collect()]


@register("lake_ingest_roundtrip", with_raw(RAW_FLAT_SQL))
def q_lake_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_raw(lake.read_raw(spark, _ingested(spark, sf_dir)))


@register("lake_ingest_compacted", with_raw(RAW_FLAT_SQL))
def q_lake_ingest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _ingested(spark, sf_dir)
    compact_partitions(spark, path, _days(lake.read_raw(spark, path)))
    return flatten_raw(lake.read_raw(spark, path))


@register("bronze_self_dedupe", with_raw(RAW_FLAT_SQL))
def q_bronze_self_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded twice, made distinct and written back over itself."""
    path = _folder(spark, "bronze")
    raw = events_as_raw(spark, sf_dir)
    for _ in range(2):
        raw.write.mode("append").partitionBy("event_date").parquet(path)
    return flatten_raw(dedupe_path(spark, path, partition_by="event_date"))


TOTALS = """SELECT question_id, CAST(SUM(COALESCE(score, 0)) AS BIGINT) AS total
FROM raw WHERE question_id IS NOT NULL GROUP BY question_id"""


@register("score_totals_text_files", with_raw(TOTALS))
def q_score_totals_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "totals")
    totals = metrics.question_score_totals(events_as_raw(spark, sf_dir, with_region=False))
    for _ in range(2):  # a rerun replaces the files
        write_score_totals_text(metrics.sorted_score_totals(totals), path)
    return lake.read_score_totals_text(spark, path)


@register(
    "daily_outputs_checked",
    with_raw(
        """SELECT 'events_by_type_daily' AS output, count(*) AS row_count
FROM (SELECT DISTINCT event_date, event_type FROM raw)
UNION ALL SELECT 'top_questions_daily', sum(least(n, 10))::BIGINT FROM (SELECT count(*) AS n FROM raw GROUP BY event_date)
UNION ALL SELECT 'answered_rate_daily', count(DISTINCT event_date) FROM raw
UNION ALL SELECT 'region_distribution', count(*) FROM (SELECT DISTINCT event_date, region FROM raw)
UNION ALL SELECT 'question_score_totals', count(DISTINCT question_id) FROM raw"""
    ),
)
def q_daily_outputs_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "outputs")
    counts = run_daily_outputs(spark, events_as_raw(spark, sf_dir), out)["row_counts"]
    paths = {name: os.path.join(out, name) for name in counts}
    checked = quality.check_outputs(spark, paths, min_rows=dict.fromkeys(paths, 1))
    return checked.select("output", "row_count")


@register(
    "daily_increment_twice",
    with_raw("SELECT event_date, event_type, count(*) AS event_count FROM raw GROUP BY ALL"),
)
def q_daily_increment_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping incremental runs store what one run over all days does."""
    base = _folder(spark, "increment")
    raw = events_as_raw(spark, sf_dir)
    raw.write.partitionBy("event_date").parquet(f"{base}/lake")
    days = _days(raw)
    for dates in (days[: 2 * len(days) // 3], days[len(days) // 3 :]):
        run_daily_increment(spark, f"{base}/lake", f"{base}/out", dates)
    return spark.read.parquet(f"{base}/out/events_by_type_daily")


@register(
    "questions_csv_roundtrip",
    with_raw(
        """SELECT question_id, make_timestamp(creation_date * 1000000) AS creation_date, title, score, answer_count,
       is_answered, link FROM raw"""
    ),
)
def q_questions_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "questions")
    rows = events_as_raw(spark, sf_dir, with_region=False).select("payload.*")
    rows = rows.withColumn("creation_date", F.timestamp_seconds("creation_date"))
    rows.write.csv(path, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss", escape='"')
    return lake.read_questions_csv(spark, path).withColumn("creation_date", F.col("creation_date").cast("timestamp_ntz"))


@register("seed_csv_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_seed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "seed")
    seed = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    seed.write.csv(path, header=True)
    return lake.read_seed_csv(spark, path, seed.schema)


@register(
    "events_erased_in_storage",
    """SELECT * FROM events
WHERE user_id IS NULL
   OR user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IS NOT NULL)""",
)
def q_events_erased_in_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "events")
    read_table(spark, sf_dir, "events").write.parquet(path)
    subjects = read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    return privacy.erase_stored(spark, path, subjects, "user_id", "c_custkey")


@register(
    "order_status_upsert_late",
    """SELECT o.o_orderkey AS order_id, coalesce(d.status, o.o_orderstatus) AS status, o.o_orderdate::DATE AS order_date
FROM orders o LEFT JOIN (
    SELECT l_orderkey, if(min(l_linestatus) = max(l_linestatus), min(l_linestatus), 'P') AS status
    FROM lineitem GROUP BY ALL
) d ON d.l_orderkey = o.o_orderkey""",
)
def q_order_status_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches out of order and one replayed: only the newest version of an order counts."""
    base = _folder(spark, "orders")
    path = f"{base}/target"
    orders = read_table(spark, sf_dir, "orders")
    keyed = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("order_date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
    )
    derived = model.derived_order_status(read_table(spark, sf_dir, "lineitem"))
    newest = keyed.drop("status").join(derived, F.col("order_id") == F.col("o_orderkey"))
    newest.select("order_id", F.col("o_orderstatus").alias("status"), "order_date", "order_month").write.parquet(f"{base}/newest")
    newest = spark.read.parquet(f"{base}/newest")  # three batches come from it
    late = keyed.withColumn("status", F.lit("late"))
    batches = [(keyed, 1), (newest, 3), (late.join(newest.select("order_id"), "order_id", "left_semi"), 2), (newest, 3)]
    apply = apply_changes_batch(spark, path, ["order_id"], ["version"], "order_month")
    for epoch, (batch, version) in enumerate(batches):
        apply(batch.select("order_id", "status", "order_date", "order_month", F.lit(version).alias("version")), epoch)
    return spark.read.parquet(path).select("order_id", "status", "order_date")


@register("bronze_conformed", with_raw(RAW_FLAT_SQL))
def q_bronze_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events with other names' case and another field order land in the bronze shape."""
    raw = events_as_raw(spark, sf_dir)
    fields = sorted(raw.schema["payload"].dataType.names, reverse=True)
    payload = F.struct(*[F.col(f"payload.{f}").alias(f.upper()) for f in fields], F.lit(1).alias("extra"))
    others = [c for c in reversed(raw.columns) if c != "payload"]
    staged = raw.select(payload.alias("Payload"), *[F.col(c).alias(c.upper()) for c in others])
    return flatten_raw(medallion.conform(staged))


@register("envelope_ids", "SELECT count(*) AS n, count(*) AS n_ids, true AS well_formed FROM events")
def q_envelope_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh ids are unique and have the shape of a UUID."""
    items = events_as_raw(spark, sf_dir, with_region=False).select("payload.*")
    made = envelope.build_envelope(items)
    shape = F.col("event_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return made.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"), F.bool_and(shape).alias("well_formed")
    )


@register("orders_row_count", "SELECT count(*) AS n FROM orders")
def q_orders_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = quality.check_row_count(read_table(spark, sf_dir, "orders"), 1, "orders")
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n"))
