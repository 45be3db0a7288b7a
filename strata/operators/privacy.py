"""Masking, role-dependent views, subject erasure and export."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import mask_email
from strata.sinks.files import overwrite_via_staging
from strata.sinks.subjects import erase_days
from strata.sinks.swap import finish_swap, observe, partition_levels

# A simple address pattern that Java and RE2 regex engines read the same way.
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

PRIVILEGED_ROLES = ("data_steward",)

Masker = Callable[[Column], Column]

MASKERS: dict[str, Masker] = {
    "email": mask_email,
    "redact": lambda c: F.when(c.isNotNull(), F.lit("***")),
    "last4": lambda c: F.when(
        c.isNotNull(), F.concat(F.lit("****"), F.substring(c.cast("string"), -4, 4))
    ),
}


def keyed_hash(key: str) -> Masker:
    """A pseudonym that only holders of ``key`` can recompute by guessing values (nested keyed digests)."""

    def mask(c: Column) -> Column:
        inner = F.sha2(F.concat(F.lit(key), F.lit("\0inner\0"), c.cast("string")), 256)
        return F.sha2(F.concat(F.lit(key), F.lit("\0outer\0"), inner), 256)

    return mask


def _masker(m: str | Masker) -> Masker:
    return MASKERS[m] if isinstance(m, str) else m


def mask_columns(df: DataFrame, masks: dict[str, str | Masker]) -> DataFrame:
    """Replace each listed column by its masked form, in one projection."""
    return df.withColumns({c: _masker(m)(F.col(c)) for c, m in masks.items()})


def role_masked(
    df: DataFrame,
    role: str,
    masks: dict[str, str | Masker],
    privileged: Iterable[str] = PRIVILEGED_ROLES,
) -> DataFrame:
    """Clear values for privileged roles, masked values for everyone else.

    Spark has no session roles, so the role is a parameter decided when the
    plan is built. A masked column takes its masker's type (text for most).
    """
    if role in set(privileged):
        return df
    return mask_columns(df, masks)


def create_masked_view(
    spark: SparkSession, df: DataFrame, name: str, role: str, masks: dict[str, str | Masker]
) -> DataFrame:
    """Register ``role_masked`` as a temporary view and return it."""
    out = role_masked(df, role, masks)
    out.createOrReplaceTempView(name)
    return spark.table(name)


def emails_in_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, email_masked): every address found in the whole text, masked.

    The regex runs only on texts containing ``@`` (an exact pre-filter: a
    text without it holds no address); the test is a plain byte search.
    """
    text = F.col(text_col)
    found = docs.filter(text.contains("@")).select(
        F.col(id_col),
        F.explode(F.regexp_extract_all(text, F.lit(EMAIL_PATTERN), 0)).alias("email"),
    )
    return found.select(F.col(id_col), mask_email(F.col("email")).alias("email_masked"))


def mask_emails_in_text(text: Column) -> Column:
    """Text with every address's local part replaced by ``***``."""
    return F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@([A-Za-z0-9.-]+\.[A-Za-z]{2,})", "***@$1")


def erase_subjects(df: DataFrame, subjects: DataFrame, key: str, subject_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not among the subjects (anti join)."""
    ids = subjects.select(F.col(subject_key or key).alias("_sid"))
    return df.join(ids, df[key] == ids["_sid"], "left_anti")


def erase_stored(
    spark: SparkSession, path: str, subjects: DataFrame, key: str, subject_key: str | None = None
) -> DataFrame:
    """Rewrite a stored Parquet table without the subjects' rows; returns the new table.

    A partitioned table keeps its layout: a scan of the key column finds the
    partitions that hold a subject, and only those are rewritten
    (``sinks.subjects`` finds them by an index instead of the scan).
    """
    finish_swap(spark, path)
    ids = subjects.select(F.col(subject_key or key).alias("_sid"))
    levels = partition_levels(spark, path)
    if not levels:
        seen = observe(spark, path)
        return overwrite_via_staging(spark, erase_subjects(spark.read.parquet(path), ids, key, "_sid"), path, seen=seen)
    table = spark.read.parquet(path)
    held = table.join(ids, table[key] == ids["_sid"], "left_semi")
    days = [r[0] for r in held.select(F.col(levels[0]).cast("string")).distinct().collect()]
    erase_days(spark, path, ids, key, days, levels[0])
    return spark.read.schema(table.schema).parquet(path)


def export_subject(df: DataFrame, key: str, value) -> DataFrame:
    """All rows of one subject (pushed down as a scan filter)."""
    return df.filter(F.col(key) == F.lit(value))


def export_subject_to(df: DataFrame, key: str, value, path: str) -> None:
    """Store all rows of one subject as JSON lines (readable without this library)."""
    export_subject(df, key, value).write.mode("overwrite").json(path)
