"""Time conversions of the event model.

ANSI mode is on, so every lenient conversion is a ``try_*`` form: a bad
timestamp becomes null (then the sentinel date) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.constants import (
    EVENT_TIME_PATTERN,
    EVENT_TIME_PATTERN_FRACTION,
    ISO_OUTPUT_PATTERN,
    SENTINEL_DATE,
)


def parse_event_time(text: Column | str, lenient: bool = False) -> Column:
    """ISO-8601 text with offset -> instant; null when it does not parse.

    Accepts ``Z`` and ``+hh:mm``. Fractional seconds do not match the strict
    pattern and give null; ``lenient=True`` also accepts six-digit fractions.
    """
    c = F.col(text) if isinstance(text, str) else text
    strict = F.try_to_timestamp(c, F.lit(EVENT_TIME_PATTERN))
    if not lenient:
        return strict
    return F.coalesce(strict, F.try_to_timestamp(c, F.lit(EVENT_TIME_PATTERN_FRACTION)))


def event_date_or_sentinel(ts: Column | str) -> Column:
    """Date of an instant in the session zone, or 1970-01-01 when null."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.to_date(c), F.lit(SENTINEL_DATE).cast("date"))


def iso_from_unix(seconds: Column | str, now_when_null: bool = True) -> Column:
    """Unix seconds -> ``yyyy-MM-ddTHH:mm:ss+00:00`` (session zone UTC).

    A missing value becomes the current instant, printed with microseconds as
    the producer does, which the strict parser then rejects.
    """
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    formatted = F.date_format(F.timestamp_seconds(c), ISO_OUTPUT_PATTERN)
    if not now_when_null:
        return formatted
    now_text = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(c.isNull(), now_text).otherwise(formatted)


def wall_clock_ntz(text: Column | str) -> Column:
    """ISO text -> zone-less timestamp keeping the wall clock, null on junk."""
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("timestamp_ntz")
