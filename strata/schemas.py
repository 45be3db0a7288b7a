"""Fixed schemas of the event model.

The event envelope is declared up front and applied when JSON is parsed, so
a bad message cannot change the table's shape.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: field names and types of the wire format ---
PAYLOAD = StructType(
    [
        StructField("question_id", LongType(), True),
        StructField("creation_date", LongType(), True),
        StructField("title", StringType(), True),
        StructField("score", IntegerType(), True),
        StructField("answer_count", IntegerType(), True),
        StructField("is_answered", BooleanType(), True),
        StructField("link", StringType(), True),
    ]
)

# The message published per observed question. ``from_json`` makes every
# field nullable whatever is declared, so checks live in strata.operators.quality.
EVENT = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_type", StringType(), True),
        StructField("timestamp", StringType(), True),
        StructField("user_id", StringType(), True),
        StructField("region", StringType(), True),
        StructField("source", StringType(), True),
        StructField("payload_version", IntegerType(), True),
        StructField("payload", PAYLOAD, True),
    ]
)

# Rows of the raw lake: the message plus derived time columns; the lake is
# partitioned by event_date.
RAW = StructType(
    EVENT.fields
    + [
        StructField("event_time", TimestampType(), True),
        StructField("event_date", DateType(), True),
    ]
)

# One landed page of the question API: a list of items and paging fields.
PAGE_ITEM = StructType(
    PAYLOAD.fields + [StructField("owner", StructType([StructField("user_id", LongType(), True)]), True)]
)

PAGE = StructType(
    [
        StructField("items", ArrayType(PAGE_ITEM), True),
        StructField("has_more", BooleanType(), True),
        StructField("backoff", IntegerType(), True),
        StructField("quota_remaining", IntegerType(), True),
    ]
)

# The flat question sample file (header row, times as text, booleans False/True).
QUESTIONS_CSV = StructType(
    [StructField(f.name, TimestampType() if f.name == "creation_date" else f.dataType, True) for f in PAYLOAD.fields]
)

SILVER_COLUMNS = [
    "event_id",
    "event_type",
    "time_posted",
    "user_id",
    "api_used",
    "question_id",
    "creation_date",
    "title",
    "score",
    "answer_count",
    "is_answered",
    "link",
]
