"""Message sinks: keyed JSON events to a topic, or to text files of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.envelope import to_messages


def publish_messages(events: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Write events as (key = event id, value = JSON) records to a topic.

    Needs the topic connector on the classpath (not bundled here). A batch
    write is at-least-once: give events deterministic ids
    (``build_envelope(id_columns=...)``) or checkpoint them first when a
    retried task must not mint new ids.
    """
    (
        to_messages(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def write_messages_text(events: DataFrame, path: str) -> None:
    """The message values as JSON lines: a landing folder the file stream source reads."""
    to_messages(events).select("value").write.mode("append").text(path)
