"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    cotraining,
    decontamination,
    language,
    mixing,
    ngram_join,
    pitman_yor,
    quality_crf,
    secrets,
    sentencepieces,
    sharding,
    spelling,
    vptree,
    whitening,
)
from strata.llm.common import fold, prepare, table
from strata.llm.oracle import ORACLE  # noqa: F401  (read with QUERIES)

QUERIES = {}


def register(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@register
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `rows`: eight shards, at most one row apart."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )
    out = sharding.shard(docs, ["doc_id", "size", "text_crc32"], shards=8, seed=2)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_no",
        "position",
    )


@register
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, in training order (of its first occurrence)."""
    mixed = mixing.by_position(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.get("passes", F.lit(0))["position"].alias("position"),
        F.get("passes", F.lit(1))["position"].alias("position_2"),
    )


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(5) == 0
    model = language.fit(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language.language(model, F.col("text"), spark).alias("r"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score", "r.n_letters")


@register
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    formats = secrets.fit(docs)
    found = docs.select("doc_id", secrets.find_secrets(formats, F.col("text"), spark).alias("spans"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != secrets.FORMAT)
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(secrets.FORMAT).alias("n_format"),
    )


@register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crf = quality_crf.fit(docs, table(spark, sf_dir, "labels"))
    found = docs.select("doc_id", quality_crf.assess(crf, F.col("text"), spark).alias("r"))
    return found.select("doc_id", "r.*")


@register
def op7_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, F.col("vec_id") % 20 == 0, k=20, factor=1.0)


@register
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", sentencepieces.encode(F.col("text")).alias("r"))
    return coded.select("doc_id", F.size("r.ids").cast("bigint").alias("n_tokens"), "r.ids", F.col("r.exact").alias("round_trip"))


@register
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@register
def op9_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, members = ngram_join.jaccard_links(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "n_equal", "n_links")


@register
def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pitman_yor.fit(docs.where(fold(10) != 0))
    scored = pitman_yor.score(model, docs)
    return scored.select(
        "doc_id",
        (fold(10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


@register
def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", cotraining.quality(model, docs).alias("r")).select("doc_id", "r.*")


@register
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register
def op12_edit_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents"))
    return spelling.forms(spelling.neighbours(words))


@register
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(whitening.fit(vectors, components=4), vectors)
