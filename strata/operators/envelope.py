"""Event envelope: API pages -> events -> messages -> parsed raw rows.

The poller's per-item dictionary building becomes one ``select``; messages
are JSON text with the event id as key, the same shape a topic carries, and
``parse_events`` + ``derive_time`` turn them back into raw lake rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import anon_user_id
from strata.functions.constants import (
    DEFAULT_REGION,
    EVENT_TYPE,
    PAYLOAD_VERSION,
    SOURCE_NAME,
)
from strata.functions.time import event_date_or_sentinel, iso_from_unix, parse_event_time
from strata.schemas import EVENT, PAGE, PAYLOAD

ITEM_FIELDS = [f.name for f in PAYLOAD.fields]


def items_from_pages(pages: DataFrame, value_col: str = "value") -> DataFrame:
    """Landed page JSON (one page per row) -> one row per item.

    A page without ``items`` (or unparsable) yields no rows. Other columns of
    ``pages`` are carried along (e.g. page number, file name).
    """
    keep = [c for c in pages.columns if c != value_col]
    parsed = pages.select(*keep, F.from_json(F.col(value_col).cast("string"), PAGE).alias("_page"))
    return parsed.select(*keep, F.explode("_page.items").alias("item")).select(*keep, "item.*")


def _event_id(id_columns: list[str] | None) -> Column:
    if not id_columns:
        return F.expr("uuid()")
    # Deterministic id: stable under recomputation and task retries.
    h = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in id_columns]))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )


def build_envelope(
    items: DataFrame,
    source: str = SOURCE_NAME,
    event_type: str = EVENT_TYPE,
    region: str = DEFAULT_REGION,
    id_columns: list[str] | None = None,
) -> DataFrame:
    """Question items -> event envelopes (the ``EVENT`` schema).

    ``event_id`` is a fresh UUID per row (re-evaluated if the frame is
    recomputed: persist or checkpoint before using it twice), or, with
    ``id_columns``, a deterministic UUID-shaped hash of those columns.
    The user is the owner's id, else ``anon-<question_id>``; the timestamp is
    the creation time in ISO form, or now when missing.
    """
    has_owner = "owner" in items.columns
    owner_id = F.col("owner.user_id") if has_owner else F.lit(None).cast("long")
    payload = F.struct(
        *[
            (F.col(f.name) if f.name in items.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in PAYLOAD.fields
        ]
    )
    return items.select(
        _event_id(id_columns).alias("event_id"),
        F.lit(event_type).alias("event_type"),
        iso_from_unix(F.col("creation_date")).alias("timestamp"),
        anon_user_id(owner_id, F.col("question_id")).alias("user_id"),
        F.lit(region).alias("region"),
        F.lit(source).alias("source"),
        F.lit(PAYLOAD_VERSION).alias("payload_version"),
        payload.alias("payload"),
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Events -> (key, value): event id and the JSON text of the envelope.

    Null fields are written as JSON nulls, as a Python serializer would.
    """
    body = F.struct(*[F.col(f.name) for f in EVENT.fields])
    return events.select(
        F.col("event_id").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def parse_events(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Message values (binary or text JSON) -> envelope columns.

    Permissive: unparsable text gives a row of nulls, a field of the wrong
    type gives a null field, the row is kept. ``keep`` carries extra source
    columns (e.g. topic offset and partition) for ordering and lineage.
    """
    keep = keep or []
    data = F.from_json(F.col(value_col).cast("string"), EVENT).alias("data")
    return messages.select(*keep, data).select("data.*", *keep)


def derive_time(events: DataFrame, lenient: bool = False) -> DataFrame:
    """Add ``event_time`` (parsed, null on bad text) and ``event_date`` (sentinel when null)."""
    return events.withColumn(
        "event_time", parse_event_time(F.col("timestamp"), lenient=lenient)
    ).withColumn("event_date", event_date_or_sentinel(F.col("event_time")))
