"""Bronze -> silver -> gold refinement of the raw lake, and the star schema.

Each step is a pure function of its input frame; writers live in
``strata.sinks``. The layer names map onto catalog databases (``bronze``,
``silver``, ``gold``) when tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType, TimestampType, VariantType

from strata.functions.constants import ONE_TIME_USER, RETURNING_USER, TABLES
from strata.functions.time import wall_clock_ntz
from strata.schemas import RAW, SILVER_COLUMNS


def _by_name(names: list[str], where: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for n in names:
        if n.lower() in found:
            raise ValueError(f"{where}: columns {found[n.lower()]!r} and {n!r} differ only in case")
        found[n.lower()] = n
    return found


def _conformed(col: Column, have: DataType, want: DataType, where: str) -> Column:
    """``col`` as type ``want``: struct fields by name at every depth, the rest by cast."""
    if isinstance(have, StructType) and isinstance(want, StructType):
        names = _by_name(have.names, where)
        fields = []
        for f in want.fields:
            src = names.get(f.name.lower())
            value = F.lit(None).cast(f.dataType)
            if src is not None:
                value = _conformed(col.getField(src), have[src].dataType, f.dataType, f"{where}.{f.name}")
            fields.append(value.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(col, lambda x: _conformed(x, have.elementType, want.elementType, f"{where}[]"))
    return col.cast(want)


def conform(df: DataFrame, schema: StructType = RAW) -> DataFrame:
    """Select ``schema``'s columns from ``df`` by name, case-insensitively, at every depth.

    Missing columns and struct fields become typed nulls, extra ones are
    dropped, and every value is cast to the declared type, so any staged file
    lands in the bronze shape. Two names that differ only in case are an error.
    """
    names = _by_name(df.columns, "table")
    cols = []
    for f in schema.fields:
        src = names.get(f.name.lower())
        value = F.lit(None).cast(f.dataType)
        if src is not None:
            value = _conformed(F.col(f"`{src}`"), df.schema[src].dataType, f.dataType, f.name)
        cols.append(value.alias(f.name))
    return df.select(*cols)


LOADED_AT = "_loaded_at"
# Topic metadata carried through silver when present (see stream_to_raw).
INGEST_ORDER = ("_broker_time", "_offset")


def load_bronze(
    bronze: DataFrame | None,
    staged: DataFrame,
    schema: StructType = RAW,
    with_load_time: bool = False,
) -> DataFrame:
    """Append staged rows to bronze, matching columns by name (any case).

    ``with_load_time`` stamps the new rows with ``_loaded_at`` (the query's
    current time); rows already in bronze keep theirs.
    """
    new = conform(staged, schema)
    if with_load_time:
        new = new.withColumn(LOADED_AT, F.current_timestamp())
    if bronze is None:
        return new
    if with_load_time:
        schema = StructType(schema.fields + [StructField(LOADED_AT, TimestampType(), True)])
    return conform(bronze, schema).unionByName(new)


def dedupe_bronze(bronze: DataFrame) -> DataFrame:
    """Whole-row distinct: removes rows loaded twice, nothing else.

    Re-polls of one question carry fresh event ids and survive; merging them
    is ``clean_silver``'s job. (Payload must stay a struct: distinct rejects
    map and variant columns.)
    """
    return bronze.distinct()


def to_silver(bronze: DataFrame) -> DataFrame:
    """Flatten the envelope into the 12 silver columns.

    ``region`` and ``payload_version`` are not carried (ingest-order
    metadata is, when present); question_id and
    creation_date become text, as in the warehouse layer. The payload may be
    the typed struct or a ``VARIANT`` (fields then read by path).
    """
    fields = [
        ("question_id", "string"),
        ("creation_date", "string"),
        ("title", "string"),
        ("score", "int"),
        ("answer_count", "int"),
        ("is_answered", "boolean"),
        ("link", "string"),
    ]
    if isinstance(bronze.schema["payload"].dataType, VariantType):
        # Semi-structured payload: path extraction with a lenient cast, a
        # field of the wrong type becomes null instead of failing the load.
        payload = [F.try_variant_get("payload", f"$.{name}", t).alias(name) for name, t in fields]
    else:
        payload = [F.col(f"payload.{name}").cast(t).alias(name) for name, t in fields]
    ingest_order = [c for c in INGEST_ORDER if c in bronze.columns]
    return bronze.select(
        F.col("event_id"),
        F.col("event_type"),
        F.col("timestamp").alias("time_posted"),
        F.col("user_id"),
        F.col("source").alias("api_used"),
        *payload,
        *ingest_order,
    )


def clean_silver(silver: DataFrame) -> DataFrame:
    """One row per question_id, the latest posting first.

    Order: posting day descending with nulls first (the warehouse's DESC
    rule), then the full time descending, then ingest order when the topic
    metadata was kept (broker time, offset: latest first), then event_id, so
    the winner is deterministic. All null question ids form one group and keep one row.
    ``time_posted`` becomes a zone-less timestamp (wall clock kept).

    ``row_number() = 1`` is planned as a partial ``WindowGroupLimit`` before
    the shuffle, so a question with very many observations ships at most one
    row per task.
    """
    posted = wall_clock_ntz("time_posted")
    ingest_order = [F.col(c).desc_nulls_last() for c in INGEST_ORDER if c in silver.columns]
    w = Window.partitionBy("question_id").orderBy(
        F.to_date(posted).desc_nulls_first(),
        posted.desc_nulls_first(),
        *ingest_order,
        F.col("event_id").asc_nulls_last(),
    )
    return (
        silver.withColumn("row_num", F.row_number().over(w))
        .filter(F.col("row_num") == 1)
        .select(*[posted.alias(c) if c == "time_posted" else F.col(c) for c in SILVER_COLUMNS])
    )


def gold_answer_rate_daily(clean: DataFrame) -> DataFrame:
    """(post_date, total_questions, questions_answered, questions_not_answered).

    The total counts non-null question ids only.
    """
    answered = F.col("is_answered")
    return clean.groupBy(F.to_date("time_posted").alias("post_date")).agg(
        F.count("question_id").alias("total_questions"),
        F.count(F.when(answered, F.lit(1))).alias("questions_answered"),
        F.count(F.when(~answered, F.lit(1))).alias("questions_not_answered"),
    )


def gold_returning_users(clean: DataFrame) -> DataFrame:
    """(is_repeat_user, user_count): users with more than one row are returning.

    Two aggregates, both with map-side combine; the null user forms its own
    group in the first step and is not counted in the second.
    """
    per_user = clean.groupBy("user_id").agg(
        F.when(F.count(F.lit(1)) > 1, F.lit(RETURNING_USER))
        .otherwise(F.lit(ONE_TIME_USER))
        .alias("is_repeat_user")
    )
    return per_user.groupBy("is_repeat_user").agg(F.count("user_id").alias("user_count"))


def gold_score_distribution(clean: DataFrame) -> DataFrame:
    """(score, score_count): histogram; the null-score group has count 0."""
    return clean.groupBy("score").agg(F.count("score").alias("score_count"))


def behavioral_fact(clean: DataFrame) -> DataFrame:
    """The fact table: every cleaned column except creation_date."""
    return clean.drop("creation_date")


def question_dimension(fact: DataFrame) -> DataFrame:
    """Question attributes (one row per question because the fact is cleaned)."""
    return fact.select(
        "question_id", "time_posted", "title", "score", "answer_count", "is_answered", "link"
    )


def user_dimension(fact: DataFrame) -> DataFrame:
    """Distinct user ids."""
    return fact.select("user_id").distinct()


def gold_tables(clean: DataFrame) -> dict[str, DataFrame]:
    """Gold marts and star schema from the cleaned silver table."""
    fact = behavioral_fact(clean)
    return {
        TABLES["answer_rate"]: gold_answer_rate_daily(clean),
        TABLES["returning_users"]: gold_returning_users(clean),
        TABLES["score_distribution"]: gold_score_distribution(clean),
        TABLES["fact"]: fact,
        TABLES["question_dimension"]: question_dimension(fact),
        TABLES["user_dimension"]: user_dimension(fact),
    }


def medallion(raw: DataFrame) -> dict[str, DataFrame]:
    """All layers from one raw frame, keyed by table name (lazy frames)."""
    bronze = dedupe_bronze(load_bronze(None, raw))
    silver = to_silver(bronze)
    clean = clean_silver(silver)
    return {
        TABLES["bronze"]: bronze,
        TABLES["silver"]: silver,
        TABLES["clean_silver"]: clean,
        **gold_tables(clean),
    }
