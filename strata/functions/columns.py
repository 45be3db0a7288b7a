"""Scalar column helpers: defaults, tiers, masking, safe arithmetic, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.constants import (
    ANON_PREFIX,
    EMAIL_MASK,
    TIER_HIGH,
    TIER_HIGH_ABOVE,
    TIER_LOW,
    TIER_LOW_BELOW,
    TIER_MEDIUM,
    UNKNOWN_QUESTION,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def anon_user_id(owner_user_id: Column | str, question_id: Column | str) -> Column:
    """Owner id as text, else ``anon-<question_id>`` (``anon-unknown`` without an id)."""
    qid = F.coalesce(_col(question_id).cast("string"), F.lit(UNKNOWN_QUESTION))
    return F.coalesce(_col(owner_user_id).cast("string"), F.concat(F.lit(ANON_PREFIX), qid))


def revenue_tier(amount: Column | str) -> Column:
    """<50 Low, 50..200 Medium (both ends included), >200 High, null stays null."""
    a = _col(amount)
    return (
        F.when(a < TIER_LOW_BELOW, F.lit(TIER_LOW))
        .when(a <= TIER_HIGH_ABOVE, F.lit(TIER_MEDIUM))
        .when(a > TIER_HIGH_ABOVE, F.lit(TIER_HIGH))
    )


def mask_email(email: Column | str) -> Column:
    """Replace everything up to the last ``@`` with ``***@``; keep the domain."""
    return F.regexp_replace(_col(email), r"^.+@", EMAIL_MASK)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that gives null instead of failing on a zero divisor."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def surrogate_key(*natural_key: Column | str) -> Column:
    """Stable 64-bit key from a natural key; same input, same key on every run.

    ``monotonically_increasing_id`` and global ``row_number`` are not stable
    across runs (and the latter runs in one task), so a hash is used.
    """
    return F.xxhash64(*[_col(c) for c in natural_key])
