"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from strata.functions.columns import (
    anon_user_id,
    mask_email,
    revenue_tier,
    safe_divide,
    surrogate_key,
)
from strata.functions.time import (
    event_date_or_sentinel,
    iso_from_unix,
    parse_event_time,
    wall_clock_ntz,
)

__all__ = [
    "anon_user_id",
    "event_date_or_sentinel",
    "iso_from_unix",
    "mask_email",
    "parse_event_time",
    "revenue_tier",
    "safe_divide",
    "surrogate_key",
    "wall_clock_ntz",
]
