"""Registered queries: raw lake shape, ingest round trips, medallion layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import envelope, medallion
from strata.operators.quality import recent_partitions
from strata.plans.catalog import register
from strata.plans.oracle import CLEAN_CTE, SILVER_CTE, with_raw
from strata.sources.driver_tables import events_as_pages, events_as_raw

RAW_FLAT_SQL = """SELECT event_id, event_type, "timestamp", user_id, region, source, payload_version,
       question_id, creation_date, title, score, answer_count, is_answered, link,
       event_time, event_date
FROM raw"""


def flatten_raw(df: DataFrame) -> DataFrame:
    """Raw rows with the payload fields as top-level columns, time zone-less."""
    cols = [
        F.col(c).cast("timestamp_ntz").alias(c) if c == "event_time" else F.col(c)
        for c in df.columns
        if c != "payload"
    ]
    return df.select(*cols, "payload.*")


@register("raw_events", with_raw(RAW_FLAT_SQL))
def q_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_raw(events_as_raw(spark, sf_dir))


@register("messages_roundtrip", with_raw(RAW_FLAT_SQL))
def q_messages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows -> keyed JSON messages -> parsed envelope -> derived time."""
    msgs = envelope.to_messages(events_as_raw(spark, sf_dir))
    parsed = envelope.derive_time(envelope.parse_events(msgs.select(F.col("value").cast("binary"))))
    return flatten_raw(parsed)


@register(
    "pages_to_events",
    with_raw(
        """SELECT 'SOCIAL_INTERACTION' AS event_type, "timestamp", user_id, 'UNKNOWN' AS region,
       source, payload_version, question_id, creation_date, title, score, answer_count,
       is_answered, link, event_time, event_date
FROM raw"""
    ),
)
def q_pages_to_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API pages -> items -> envelopes (ids are fresh UUIDs, not compared)."""
    items = envelope.items_from_pages(events_as_pages(spark, sf_dir)).drop("page_no")
    events = envelope.derive_time(envelope.build_envelope(items))
    return flatten_raw(events).drop("event_id")


@register(
    "bronze_reload_dedupe",
    with_raw(f"SELECT DISTINCT * FROM ({RAW_FLAT_SQL} UNION ALL {RAW_FLAT_SQL}) t"),
)
def q_bronze_reload_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows staged twice, then whole-row dedupe restores the count."""
    raw = events_as_raw(spark, sf_dir)
    bronze = medallion.load_bronze(medallion.load_bronze(None, raw), raw)
    return flatten_raw(medallion.dedupe_bronze(bronze))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.to_silver(events_as_raw(spark, sf_dir, with_region=False))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.clean_silver(_silver(spark, sf_dir))


@register("silver_events", with_raw("SELECT * FROM silver", SILVER_CTE))
def q_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@register("silver_events_variant", with_raw("SELECT * FROM silver", SILVER_CTE))
def q_silver_events_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze that kept its payload as a VARIANT, flattened by path."""
    raw = events_as_raw(spark, sf_dir, with_region=False)
    bronze = raw.withColumn("payload", F.parse_json(F.to_json("payload")))
    return medallion.to_silver(bronze)


@register("clean_silver", with_raw("SELECT * FROM clean", SILVER_CTE, CLEAN_CTE))
def q_clean_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@register(
    "gold_answer_rate_daily",
    with_raw(
        """SELECT time_posted::DATE AS post_date, count(question_id) AS total_questions,
    count(*) FILTER (is_answered) AS questions_answered,
    count(*) FILTER (NOT is_answered) AS questions_not_answered
FROM clean GROUP BY ALL""",
        SILVER_CTE,
        CLEAN_CTE,
    ),
)
def q_gold_answer_rate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.gold_answer_rate_daily(_clean(spark, sf_dir))


@register(
    "gold_returning_users",
    with_raw(
        # How many users have each number of questions, then the two classes.
        """SELECT if(questions = 1, 'One_time_user', 'Returning_user') AS is_repeat_user,
    sum(users)::BIGINT AS user_count
FROM (SELECT questions, count(user_id) AS users
      FROM (SELECT user_id, count(*) AS questions FROM clean GROUP BY ALL) GROUP BY ALL)
GROUP BY ALL""",
        SILVER_CTE,
        CLEAN_CTE,
    ),
)
def q_gold_returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.gold_returning_users(_clean(spark, sf_dir))


@register(
    "gold_score_distribution",
    with_raw(
        "SELECT score, COUNT(score) AS score_count FROM clean GROUP BY score",
        SILVER_CTE,
        CLEAN_CTE,
    ),
)
def q_gold_score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.gold_score_distribution(_clean(spark, sf_dir))


@register(
    "gold_behavioral_fact",
    with_raw(
        """SELECT event_id, event_type, time_posted, user_id, api_used, question_id, title, score,
       answer_count, is_answered, link FROM clean""",
        SILVER_CTE,
        CLEAN_CTE,
    ),
)
def q_gold_behavioral_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.behavioral_fact(_clean(spark, sf_dir))


@register(
    "gold_question_dimension",
    with_raw(
        """SELECT question_id, time_posted, title, score, answer_count, is_answered, link
FROM clean""",
        SILVER_CTE,
        CLEAN_CTE,
    ),
)
def q_gold_question_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.question_dimension(medallion.behavioral_fact(_clean(spark, sf_dir)))


@register(
    "gold_user_dimension",
    with_raw("SELECT DISTINCT user_id FROM clean", SILVER_CTE, CLEAN_CTE),
)
def q_gold_user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.user_dimension(medallion.behavioral_fact(_clean(spark, sf_dir)))


@register(
    "recent_partitions",
    with_raw(
        """SELECT event_date FROM (SELECT DISTINCT event_date FROM raw) d
ORDER BY event_date DESC LIMIT 5"""
    ),
)
def q_recent_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_partitions(events_as_raw(spark, sf_dir, with_region=False), n=5)
