"""Streaming ingest: message stream -> parsed events -> date-partitioned Parquet lake.

The source is a topic (``kafka``) or a landing folder of JSON lines
(``files``, one message per line, same ``value`` column). The connector jar
for topics is not bundled; the topic path is configuration only here and the
file path is what the tests drive. Progress is kept in the checkpoint folder.
Each micro-batch replaces the folders (day, query and epoch) that are its own,
so a replayed batch adds no rows and a rerun over the same input neither. The
lake has no file log, so its days can be compacted and read by any reader.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.envelope import derive_time, parse_events
from strata.sinks.compaction import INGEST_COL, merged_epochs
from strata.sinks.swap import child_names, read_text

# Topic metadata kept on request, renamed so it cannot collide with envelope
# fields (the envelope has its own ``timestamp``).
TOPIC_METADATA = {"partition": "_partition", "offset": "_offset", "timestamp": "_broker_time"}


def read_event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    *,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    path: str | None = None,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """A streaming frame with a ``value`` column holding message JSON.

    ``clean_source`` ("delete" or "archive") removes or moves landed files
    once they are committed, the way a purge-after-load does.
    """
    if fmt == "kafka":
        if not (bootstrap_servers and topic):
            raise ValueError("kafka source needs bootstrap_servers and topic")
        r = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        return r.load()
    if fmt == "files":
        if not path:
            raise ValueError("files source needs a landing path")
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        if clean_source:
            r = r.option("cleanSource", clean_source)
            if archive_dir:
                r = r.option("sourceArchiveDir", archive_dir)
        return r.load(path)
    raise ValueError(f"unknown stream format {fmt!r}")


def stream_to_raw(stream: DataFrame, lenient: bool = False, keep_metadata: bool = False) -> DataFrame:
    """Message stream -> raw lake rows (envelope + event_time + event_date).

    With ``keep_metadata`` the topic partition, offset and broker time are
    kept as ``_partition``, ``_offset`` and ``_broker_time``, which gives a
    true ingest order for "latest" questions.
    """
    meta = {c: alias for c, alias in TOPIC_METADATA.items() if keep_metadata and c in stream.columns}
    if meta:
        stream = stream.withColumnsRenamed(meta)
    return derive_time(parse_events(stream, "value", keep=list(meta.values())), lenient=lenient)


def once_per_event(raw: DataFrame, within: str = "1 day", key: str = "event_id") -> DataFrame:
    """Let each event through once, however often the stream delivers it within ``within`` of its arrival.

    State is kept per event id and dropped by arrival time, so it doesn't depend
    on the events' own times (which may be missing or old), and it is part of
    the checkpoint, so a restart remembers. Rows without an id count as equal if
    all their columns are.
    """
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"ignoreNullFields": "false"})
    named = F.coalesce(F.concat(F.lit("id:"), F.col(key)), F.concat(F.lit("row:"), F.sha2(content, 256)))
    timed = raw.withColumns({"_named": named, "_arrived": F.current_timestamp()}).withWatermark("_arrived", within)
    return timed.dropDuplicatesWithinWatermark(["_named"]).drop("_named", "_arrived")


def start_raw_sink(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "available_now",
    interval: str = "10 seconds",
    query_name: str | None = None,
) -> StreamingQuery:
    """Append raw rows to Parquet partitioned by event_date and, below it, by batch.

    ``trigger``: "available_now" drains what is there and stops (the one-shot
    mode); "processing_time" runs a micro-batch every ``interval``. Rows of a
    replayed epoch that compaction has merged already are not written again.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        query = json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]  # of this checkpoint
        days = [d for d in child_names(spark, path) if d.startswith("event_date=")]
        done = [day for day, last in merged_epochs(spark, path, days).items() if last.get(query, -1) >= epoch]
        if done:
            day = F.concat(F.lit("event_date="), F.col("event_date").cast("string"))
            batch = batch.filter(~F.coalesce(day.isin(done), F.lit(False)))
        (
            batch.withColumn(INGEST_COL, F.lit(f"{query}-epoch{epoch}"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", INGEST_COL)
            .parquet(path)
        )

    w = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    elif trigger == "processing_time":
        w = w.trigger(processingTime=interval)
    else:
        raise ValueError(f"unknown trigger {trigger!r}")
    return w.start()


def run_bounded(query: StreamingQuery, seconds: float) -> bool:
    """Wait up to ``seconds``; stop the query if it is still running.

    Returns True when the query ended on its own. Errors of the query are
    raised, not swallowed.
    """
    ended = query.awaitTermination(seconds)
    if not ended and query.isActive:
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise exc
    return bool(ended)


def ingest(
    spark: SparkSession,
    lake_path: str,
    checkpoint: str,
    source: dict,
    trigger: str = "available_now",
    interval: str = "10 seconds",
    run_seconds: float = 300,
    lenient: bool = False,
    once_within: str | None = None,
) -> StreamingQuery:
    """Source -> parse -> lake; one-shot drain or a bounded interval run.

    ``once_within``: drop events that were delivered before (``once_per_event``).
    """
    raw = stream_to_raw(read_event_stream(spark, **source), lenient=lenient)
    if once_within:
        raw = once_per_event(raw, once_within)
    query = start_raw_sink(raw, lake_path, checkpoint, trigger, interval)
    if trigger == "available_now":
        query.awaitTermination()
        exc = query.exception()
        if exc is not None:
            raise exc
    else:
        run_bounded(query, run_seconds)
    return query
