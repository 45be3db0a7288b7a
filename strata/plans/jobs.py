"""End-to-end runs composed from sources, operators and sinks.

- ``run_daily_outputs``: the four daily outputs and the score totals (Parquet
  and text) from one projected, persisted base, then output validation.
- ``run_daily_increment``: the same for chosen lake partitions only.
- ``run_medallion``: bronze -> silver -> clean -> star schema and gold marts,
  each layer stored and read back before the next.
- ``run_daily_cycle``: one scheduled cycle in the event model's order:
  ingest -> raw check -> daily outputs -> validation -> layers.
- ``run_incremental_cycle``: the same for the days that got new rows only.
- ``publish_pages``: landed API pages -> envelopes (checkpointed) -> messages.
"""

from __future__ import annotations

import json
import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.constants import TABLES
from strata.operators import medallion, metrics, quality
from strata.sinks import files as sinks
from strata.sinks.swap import child_names, finish_swap, path_exists, read_text, replace, write_text

DAILY_OUTPUTS = (
    "events_by_type_daily",
    "top_questions_daily",
    "answered_rate_daily",
    "region_distribution",
)
TOTALS_PARQUET = "question_score_totals"
TOTALS_TEXT = "question_score_totals_text"

RAW_COLUMNS = ["event_id", "event_type", "region", "event_time", "event_date"]
# The payload fields that the outputs read; the rest is never kept in memory.
PAYLOAD_FIELDS = ["question_id", "title", "score", "answer_count", "is_answered"]


def _narrow(raw: DataFrame) -> DataFrame:
    payload = F.struct(*[F.col(f"payload.{f}").alias(f) for f in PAYLOAD_FIELDS])
    return raw.select(*RAW_COLUMNS, F.when(F.col("payload").isNotNull(), payload).alias("payload"))


def run_daily_outputs(
    spark: SparkSession, raw: DataFrame, out_dir: str, use_partition_date: bool = False
) -> dict:
    """Compute and write the four daily outputs and the score totals; validate them.

    The base is projected to the columns the outputs read before it is
    persisted (memory, spilling to disk), then released. Returns row counts
    and the number of malformed rows skipped by the totals.
    """
    base = _narrow(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        paths = {}
        for name, df in metrics.daily_metrics(base, use_partition_date).items():
            paths[name] = os.path.join(out_dir, name)
            sinks.write_output(df, paths[name])
        obs = Observation("malformed")
        totals = metrics.question_score_totals(base, observation=obs)
        paths[TOTALS_PARQUET] = os.path.join(out_dir, TOTALS_PARQUET)
        sinks.write_output(totals, paths[TOTALS_PARQUET])
        malformed = obs.get.get("malformed_rows", 0)
        stored = spark.read.parquet(paths[TOTALS_PARQUET])
        sinks.write_score_totals_text(metrics.sorted_score_totals(stored), os.path.join(out_dir, TOTALS_TEXT))
    finally:
        base.unpersist()
    checked = quality.check_outputs(spark, paths)
    counts = {r["output"]: r["row_count"] for r in checked.collect()}
    return {"row_counts": counts, "malformed_rows": malformed}


def run_medallion(spark: SparkSession, raw: DataFrame, prefix: str = "", location: str | None = None) -> dict[str, int]:
    """Build bronze, silver and gold tables in the session catalog.

    ``prefix`` is prepended to the layer database names (test isolation), and
    the databases lie below ``location`` if given.
    Returns the row count of each table.
    """
    layers = [f"{prefix}{layer}" for layer in sinks.LAYERS]
    sinks.ensure_layers(spark, layers, location)
    # Each layer is stored and read back before the next is derived: the
    # clean table feeds six gold tables without recomputing its window, and
    # a lost executor re-reads stored files instead of replaying the lineage.
    names = {n: f"{prefix}{n}" for n in medallion.medallion(raw)}
    bronze = medallion.dedupe_bronze(medallion.load_bronze(None, raw))
    sinks.replace_table(spark, bronze, names[TABLES["bronze"]])
    silver = medallion.to_silver(spark.table(names[TABLES["bronze"]]))
    sinks.replace_table(spark, silver, names[TABLES["silver"]])
    clean = medallion.clean_silver(spark.table(names[TABLES["silver"]]))
    sinks.replace_table(spark, clean, names[TABLES["clean_silver"]])
    for name, df in medallion.gold_tables(spark.table(names[TABLES["clean_silver"]])).items():
        sinks.replace_table(spark, df, names[name])
    return {target: spark.table(target).count() for target in names.values()}


TOTALS_DAILY = "question_score_totals_daily"


def write_days(df: DataFrame, path: str, dates: list[str]) -> None:
    """Replace the given event_date partitions by those rows; a day without rows is removed.

    ``df`` must have rows of those days only, and not read ``path``.
    """
    spark = df.sparkSession
    finish_swap(spark, path)
    names = [f"event_date={d}" for d in dates]
    replace(spark, path, lambda folder: df.write.partitionBy("event_date").parquet(folder), names=names)


def run_daily_increment(spark: SparkSession, lake_path: str, out_dir: str, dates: list[str]) -> dict:
    """Recompute the daily outputs for the given lake partitions only.

    The lake is read with its partition column, so the date filter prunes
    folders at the scan; outputs are partitioned by event_date and only the
    given days are replaced (a day that has no rows any more is removed), which
    makes a rerun of a day idempotent. Days
    are the stored partition values (``use_partition_date`` semantics).

    Score totals keep a per-day table (question, day, total) replaced the same
    way; the cumulative totals are re-aggregated from it (one row per question
    and day, far fewer than the raw observations) and swapped in via staging.
    """
    from strata.sources.lake import read_raw

    day_values = [F.lit(d).cast("date") for d in dates]
    raw = read_raw(spark, lake_path).filter(F.col("event_date").isin(day_values))
    base = _narrow(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, df in metrics.daily_metrics(base, use_partition_date=True).items():
            write_days(df, os.path.join(out_dir, name), dates)
        per_day = (
            base.filter(~metrics.malformed_condition())
            .groupBy("event_date", F.col("payload.question_id").alias("question_id"))
            .agg(F.sum(F.coalesce(F.col("payload.score"), F.lit(0)).cast("long")).alias("total"))
        )
        write_days(per_day, os.path.join(out_dir, TOTALS_DAILY), dates)
    finally:
        base.unpersist()
    finish_swap(spark, os.path.join(out_dir, TOTALS_PARQUET))
    cumulative = (
        spark.read.parquet(os.path.join(out_dir, TOTALS_DAILY))
        .groupBy("question_id")
        .agg(F.sum("total").alias("total"))
    )
    sinks.overwrite_via_staging(spark, cumulative, os.path.join(out_dir, TOTALS_PARQUET))
    outputs = {n: os.path.join(out_dir, n) for n in DAILY_OUTPUTS + (TOTALS_PARQUET,)}
    checked = quality.check_outputs(spark, outputs)
    return {r["output"]: r["row_count"] for r in checked.collect()}


def run_daily_cycle(
    spark: SparkSession,
    source: dict,
    lake_path: str,
    checkpoint: str,
    out_dir: str,
    table_prefix: str = "",
) -> dict:
    """One scheduled cycle, steps in order, each failing loudly.

    Drain the source into the lake (one-shot trigger), check the lake has
    partitions, compute and validate the daily outputs, then rebuild the
    bronze/silver/gold tables. Every step reads what the previous one stored,
    so a failed cycle can be rerun from the step that failed.
    """
    from strata.sources.lake import read_raw
    from strata.streaming.ingest import ingest

    ingest(spark, lake_path, checkpoint, source, trigger="available_now")
    raw = read_raw(spark, lake_path)
    recent = [str(r.event_date) for r in quality.check_raw_partitions(raw).collect()]
    daily = run_daily_outputs(spark, raw, out_dir)
    tables = run_medallion(spark, raw, prefix=table_prefix)
    return {"recent_partitions": recent, **daily, "tables": tables}


def _batches(spark: SparkSession, lake_path: str) -> dict[str, list[str]]:
    days = [n for n in child_names(spark, lake_path) if n.startswith("event_date=")]
    return {d: child_names(spark, f"{lake_path.rstrip('/')}/{d}") for d in days}


def run_incremental_cycle(
    spark: SparkSession, source: dict, lake_path: str, checkpoint: str, out_dir: str, distinct_path: str | None = None
) -> dict:
    """One scheduled cycle whose work follows the new data.

    Drains the source into the lake and takes the days that got rows (new batch
    folders under the day). Only those are read again: their daily outputs and
    totals (``run_daily_increment``), their value states, and, with
    ``distinct_path``, the new batches are appended there without rows that it
    holds already (``sinks.distinct``). A cycle that failed is simply run again
    with the days of its predecessor: days whose outputs are older than their
    rows are found by the batches noted with the outputs.
    """
    from strata.operators.states import value_states
    from strata.sinks.compaction import INGEST_COL
    from strata.sinks.distinct import append_distinct
    from strata.sources.lake import read_raw
    from strata.streaming.ingest import ingest

    ingest(spark, lake_path, checkpoint, source, trigger="available_now")
    noted = os.path.join(out_dir, "_batches")
    before = json.loads(read_text(spark, noted)) if path_exists(spark, noted) else {}
    now = _batches(spark, lake_path)
    dates = sorted(d.partition("=")[2] for d in now if now[d] != before.get(d))
    if not dates:
        return {"days": [], "row_counts": {}}
    counts = run_daily_increment(spark, lake_path, out_dir, dates)
    days = F.col("event_date").isin([F.lit(d).cast("date") for d in dates])
    raw = read_raw(spark, lake_path).filter(days)
    states = value_states(raw, ["event_date", F.date_trunc("hour", "event_time").alias("hour"), "event_type"], "payload.score", "user_id")
    write_days(states, os.path.join(out_dir, "value_states"), dates)
    if distinct_path:
        new = sorted({b.partition("=")[2] for d in now for b in now[d] if b not in before.get(d, [])})
        for batch in new:
            rows = spark.read.schema(raw.schema.add(INGEST_COL, "string")).parquet(lake_path)
            append_distinct(spark, distinct_path, rows.filter(days & (F.col(INGEST_COL) == batch)).select(*raw.columns), batch)
    write_text(spark, noted, json.dumps(now))
    return {"days": dates, "row_counts": counts}


def publish_pages(
    spark: SparkSession,
    pages: DataFrame,
    landing_path: str | None = None,
    topic: tuple[str, str] | None = None,
) -> DataFrame:
    """Landed API pages -> event envelopes -> messages (the producer's cycle).

    Event ids are fresh UUIDs, so the envelopes are checkpointed (reliably,
    under ``spark.checkpoint.dir``) before they are used: every sink and the
    returned frame see the same ids, and a lost executor re-reads the
    checkpoint instead of minting new ones. ``topic`` is (bootstrap servers,
    topic name); ``landing_path`` appends JSON lines a file stream can read.
    """
    from strata.operators.envelope import build_envelope, items_from_pages
    from strata.session import checkpoint_root
    from strata.sinks.messages import publish_messages, write_messages_text

    checkpoint_root(spark)
    events = build_envelope(items_from_pages(pages)).checkpoint(eager=True)
    if landing_path:
        write_messages_text(events, landing_path)
    if topic:
        publish_messages(events, *topic)
    return events
