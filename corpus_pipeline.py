"""A training corpus out of ``documents``: five stages, each one operator of strata.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents. Extra columns pass through unchanged. Null texts and
texts without a letter are rejected by the first stage; an empty table stays
empty through all stages.

1. language_id    keeps documents of a learned language and fills in a missing
                  ``lang``; documents without a letter, or far below what
                  documents of their language usually reach, go.
2. near_duplicates  keeps one document of each group of linked documents: the
                  one with the smallest id.
3. secrets        replaces every secret in the text by its kind in brackets and
                  updates ``n_chars``.
4. mixing         repeats and drops documents by their source's target, in
                  training order.
5. sentencepiece  encodes the texts: doc_id, lang, source, n_tokens, ids.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import language, mixing, ngram_join, secrets, sentencepieces
from strata.llm.common import prepare
from strata.session import checkpoint_root

#: Least score: a text's part of what documents of its language usually reach, so alphabets of any size are alike.
MIN_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs)
    found = docs.withColumn("__r", language.language(model, F.col("text"), spark))
    kept = found.where((F.col("__r.lang_pred") != language.UNKNOWN) & (F.col("__r.score") >= MIN_LANGUAGE_SCORE))
    filled = kept.withColumn("lang", F.coalesce("lang", "__r.lang_pred"))
    return filled.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words have no group: all of them stay."""
    found = ngram_join.jaccard_components(docs)
    by_group = found.where("component IS NOT NULL").groupBy("component")
    first = by_group.agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "set_id")).alias("m"))
    first = first.select(F.col("m.doc_id").alias("__id"), F.col("m.set_id").alias("__set"))
    named = docs.withColumn("__sid", ngram_join.set_ids(F.col("text"))["sid"])
    chosen = named.join(first, (F.col("__sid") == F.col("__set")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    # Rows of one id and text repeat: one of them.
    order = Window.partitionBy("__sid").orderBy(*[F.col(f"`{c}`") for c in docs.columns])
    one = chosen.withColumn("__n", F.row_number().over(order)).where("__n = 1")
    wordless = named.where("__sid IS NULL")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return one.select(*columns).unionByName(wordless.select(*columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    formats = secrets.fit(docs)
    found = docs.withColumn("__spans", secrets.find_secrets(formats, F.col("text"), spark))
    clean = found.withColumn("__text", secrets.redact(F.col("text"), F.col("__spans")))
    changed = F.size("__spans") > 0
    clean = clean.withColumn("n_chars", F.when(changed, F.length("__text").cast("bigint")).otherwise(F.col("n_chars")))
    clean = clean.withColumn("text", F.col("__text"))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = docs.select("doc_id", "lang", "source", sentencepieces.encode(F.col("text"))["ids"].alias("ids"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


def _stage(fn):
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _stage(language_id)),
    ("near_duplicates", _stage(near_duplicates)),
    ("secrets", _stage(redact_secrets)),
    ("mixing", _stage(mix_sources)),
    ("sentencepiece", _stage(encode)),
]

#: Learned models, hashed joins and a tokenizer: SQL can't express the stages (tests/llm compares with brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the intermediate results go to the shared folder."""
    root = f"{checkpoint_root(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
