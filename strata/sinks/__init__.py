"""Writers for outputs, tables and text."""

from strata.sinks.files import (
    clone_database,
    create_views,
    dedupe_path,
    ensure_layers,
    overwrite_via_staging,
    replace_table,
    score_totals_as_text,
    write_bucketed,
    write_output,
    write_score_totals_text,
)
from strata.sinks.compaction import compact_partitions
from strata.sinks.messages import publish_messages, write_messages_text

__all__ = [
    "clone_database",
    "compact_partitions",
    "create_views",
    "dedupe_path",
    "ensure_layers",
    "overwrite_via_staging",
    "publish_messages",
    "replace_table",
    "score_totals_as_text",
    "write_bucketed",
    "write_output",
    "write_messages_text",
    "write_score_totals_text",
]
