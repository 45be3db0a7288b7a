"""Readers of the raw lake, outputs and small landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.schemas import QUESTIONS_CSV, RAW

SCORE_TUPLE = r"^\((-?\d+), (-?\d+)\)$"


def read_raw(spark: SparkSession, path: str, schema: StructType = RAW) -> DataFrame:
    """The date-partitioned raw lake with its fixed schema.

    Reading the root keeps ``event_date`` as a partition column, so a filter
    on it prunes whole folders. The batch level below it (if the lake was
    ingested) is left out.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_output(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def preview(df: DataFrame, n: int = 20) -> tuple[str, DataFrame]:
    """(schema text, first n rows) of an output, for display."""
    return df.schema.simpleString(), df.limit(n)


def read_questions_csv(spark: SparkSession, path: str) -> DataFrame:
    """The flat question file: header row, ``yyyy-MM-dd HH:mm:ss`` times, False/True."""
    return spark.read.csv(
        path,
        header=True,
        schema=QUESTIONS_CSV,
        timestampFormat="yyyy-MM-dd HH:mm:ss",
        escape='"',
        mode="PERMISSIVE",
    )


def read_seed_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A static seed table from CSV with an explicit schema (no inference pass)."""
    return spark.read.csv(path, header=True, schema=schema)


def parse_score_totals_text(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``(id, total)`` text lines -> (question_id, total); bad lines give nulls."""
    v = F.col(value_col)
    matched = v.rlike(SCORE_TUPLE)
    return lines.select(
        F.when(matched, F.regexp_extract(v, SCORE_TUPLE, 1).cast("long")).alias("question_id"),
        F.when(matched, F.regexp_extract(v, SCORE_TUPLE, 2).cast("long")).alias("total"),
    )


def read_score_totals_text(spark: SparkSession, path: str) -> DataFrame:
    """Read back the text sink of the score totals (no ``eval`` of the text)."""
    return parse_score_totals_text(spark.read.text(path))


def store_variant(df: DataFrame, path: str, *json_cols: str) -> None:
    """Store JSON text columns as VARIANT: parsed once, here; text that isn't JSON becomes null."""
    df.withColumns({c: F.try_parse_json(c) for c in json_cols}).write.parquet(path)


def variant_field(column: str, path: str, as_type: str):
    """A field of a stored VARIANT by path; null if it is missing or has another type."""
    return F.try_variant_get(column, path, as_type)
