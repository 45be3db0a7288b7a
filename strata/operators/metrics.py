"""Daily behaviour metrics over raw lake rows.

Input: a DataFrame with the raw lake schema (``strata.schemas.RAW``).

By default the day is recomputed as ``to_date(event_time)``, as the batch job
of the event model does: rows whose time did not parse land in a null-day
group rather than the 1970-01-01 partition. ``use_partition_date=True``
groups on the stored ``event_date`` partition column instead, which keeps
partition pruning on date filters.

Plans (checked with ``explain``): the counts are partial + final hash
aggregates (map-side combine, so a hot day or region costs one row per task
before the shuffle); top-k per day is ``row_number <= k`` which Catalyst turns
into a partial ``WindowGroupLimit`` ahead of the exchange, so at most k rows
per day per task cross the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions.constants import TOP_QUESTIONS_K


def _day(use_partition_date: bool) -> Column:
    if use_partition_date:
        return F.col("event_date")
    return F.to_date(F.col("event_time")).alias("event_date")


def events_by_type_daily(raw: DataFrame, use_partition_date: bool = False) -> DataFrame:
    """(event_date, event_type, event_count): rows per day and event type."""
    return raw.groupBy(_day(use_partition_date), F.col("event_type")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def region_distribution(raw: DataFrame, use_partition_date: bool = False) -> DataFrame:
    """(event_date, region, event_count): rows per day and region."""
    return raw.groupBy(_day(use_partition_date), F.col("region")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def answered_rate_daily(raw: DataFrame, use_partition_date: bool = False) -> DataFrame:
    """(event_date, total_questions, answered, unanswered) per day.

    Every row counts in the total; a null ``is_answered`` (or null payload)
    counts in neither answered nor unanswered, so total >= answered + unanswered.
    """
    answered = F.col("payload.is_answered")
    return raw.groupBy(_day(use_partition_date)).agg(
        F.count(F.lit(1)).alias("total_questions"),
        F.count_if(answered).alias("answered"),
        F.count_if(~answered).alias("unanswered"),
    )


def top_questions_daily(
    raw: DataFrame,
    k: int = TOP_QUESTIONS_K,
    use_partition_date: bool = False,
    distinct_questions: bool = False,
) -> DataFrame:
    """The k highest-scored observations per day.

    (event_date, question_id, title, score, answer_count). Null scores sort
    last; equal scores are broken by event_id so the result is deterministic.
    Observations are ranked, so one question may take several places;
    ``distinct_questions=True`` keeps only each question's best observation
    per day first.
    """
    rows = raw.select(
        _day(use_partition_date),
        F.col("event_id"),
        F.col("payload.question_id").alias("question_id"),
        F.col("payload.title").alias("title"),
        F.col("payload.score").alias("score"),
        F.col("payload.answer_count").alias("answer_count"),
    )
    order = [F.col("score").desc_nulls_last(), F.col("event_id").asc_nulls_last()]
    if distinct_questions:
        per_question = Window.partitionBy("event_date", "question_id").orderBy(*order)
        rows = (
            rows.withColumn("_q", F.row_number().over(per_question))
            .filter(F.col("_q") == 1)
            .drop("_q")
        )
    by_day = Window.partitionBy("event_date").orderBy(*order)
    return (
        rows.withColumn("rank", F.row_number().over(by_day))
        .filter(F.col("rank") <= k)
        .select("event_date", "question_id", "title", "score", "answer_count")
    )


def malformed_condition() -> Column:
    """A row without payload or without question id cannot be keyed."""
    return F.col("payload").isNull() | F.col("payload.question_id").isNull()


def question_score_totals(raw: DataFrame, observation: Observation | None = None) -> DataFrame:
    """(question_id, total): sum of scores over all observations of a question.

    Rows without a payload or question id are skipped; a null score adds 0.
    A question observed n times contributes its score n times ("sum over
    observations"). When an ``Observation`` is given, the skipped rows are
    counted as ``malformed_rows`` in the same pass; unlike an accumulator this
    is not double-counted when a task is retried.
    """
    if observation is not None:
        raw = raw.observe(observation, F.count_if(malformed_condition()).alias("malformed_rows"))
    keyed = raw.filter(~malformed_condition())
    return keyed.groupBy(F.col("payload.question_id").alias("question_id")).agg(
        F.sum(F.coalesce(F.col("payload.score"), F.lit(0)).cast("long")).alias("total")
    )


def top_score_totals(totals: DataFrame, n: int = 20) -> DataFrame:
    """The n largest totals, ties by question id (a ``TakeOrderedAndProject``)."""
    return totals.orderBy(F.col("total").desc(), F.col("question_id").asc()).limit(n)


def sorted_score_totals(totals: DataFrame) -> DataFrame:
    """All totals in descending order (range-partitioned global sort)."""
    return totals.orderBy(F.col("total").desc(), F.col("question_id").asc())


def daily_metrics(raw: DataFrame, use_partition_date: bool = False) -> dict[str, DataFrame]:
    """The four daily outputs of the DataFrame job, keyed by output name."""
    return {
        "events_by_type_daily": events_by_type_daily(raw, use_partition_date),
        "top_questions_daily": top_questions_daily(raw, use_partition_date=use_partition_date),
        "answered_rate_daily": answered_rate_daily(raw, use_partition_date),
        "region_distribution": region_distribution(raw, use_partition_date),
    }
