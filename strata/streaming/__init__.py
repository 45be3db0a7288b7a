"""Structured Streaming: ingest to the lake, windowed aggregates, joins, change apply."""

from strata.streaming.ingest import (
    ingest,
    read_event_stream,
    run_bounded,
    start_raw_sink,
    stream_to_raw,
)
from strata.streaming.upsert import apply_changes_batch, merge_changes, start_apply_changes
from strata.streaming.windows import join_status_updates, windowed_summary

__all__ = [
    "apply_changes_batch",
    "ingest",
    "join_status_updates",
    "merge_changes",
    "read_event_stream",
    "run_bounded",
    "start_apply_changes",
    "start_raw_sink",
    "stream_to_raw",
    "windowed_summary",
]
