"""Sources: benchmark tables and their event adapter, the raw lake, landed files."""

from strata.sources.driver_tables import (
    customer_regions,
    events_as_items,
    events_as_pages,
    events_as_raw,
    read_table,
)
from strata.sources.lake import (
    parse_score_totals_text,
    preview,
    read_output,
    read_questions_csv,
    read_raw,
    read_score_totals_text,
    read_seed_csv,
)

__all__ = [
    "customer_regions",
    "events_as_items",
    "events_as_pages",
    "events_as_raw",
    "parse_score_totals_text",
    "preview",
    "read_output",
    "read_questions_csv",
    "read_raw",
    "read_score_totals_text",
    "read_seed_csv",
    "read_table",
]
