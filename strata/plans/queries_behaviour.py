"""Registered queries over the event model (batch outputs of the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators import metrics
from strata.plans.catalog import register
from strata.plans.oracle import with_raw
from strata.sources.driver_tables import events_as_raw, region_counts


@register(
    "events_by_type_daily",
    with_raw(
        """SELECT CAST(event_time AS DATE) AS event_date, event_type, COUNT(*) AS event_count
FROM raw GROUP BY 1, 2"""
    ),
)
def q_events_by_type_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.events_by_type_daily(events_as_raw(spark, sf_dir, with_region=False))


@register(
    "top_questions_daily",
    with_raw(
        """SELECT event_date, question_id, title, score, answer_count FROM (
    SELECT CAST(event_time AS DATE) AS event_date, question_id, title, score, answer_count,
           ROW_NUMBER() OVER (PARTITION BY CAST(event_time AS DATE)
                              ORDER BY score DESC NULLS LAST, event_id ASC) AS rn
    FROM raw) t
WHERE rn <= 10"""
    ),
)
def q_top_questions_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.top_questions_daily(events_as_raw(spark, sf_dir, with_region=False))


@register(
    "answered_rate_daily",
    with_raw(
        """SELECT CAST(event_time AS DATE) AS event_date,
       COUNT(*) AS total_questions,
       COUNT(*) FILTER (WHERE is_answered) AS answered,
       COUNT(*) FILTER (WHERE NOT is_answered) AS unanswered
FROM raw GROUP BY 1"""
    ),
)
def q_answered_rate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.answered_rate_daily(events_as_raw(spark, sf_dir, with_region=False))


@register(
    "region_distribution",
    with_raw(
        """SELECT CAST(event_time AS DATE) AS event_date, region, COUNT(*) AS event_count
FROM raw GROUP BY 1, 2"""
    ),
)
def q_region_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_counts(spark, sf_dir)


@register(
    "question_score_totals",
    with_raw(
        """SELECT question_id, CAST(SUM(COALESCE(score, 0)) AS BIGINT) AS total
FROM raw WHERE question_id IS NOT NULL GROUP BY question_id"""
    ),
)
def q_question_score_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.question_score_totals(events_as_raw(spark, sf_dir, with_region=False))
