"""Copies of hot rows and ranked samples, as the operators share them."""

from __future__ import annotations

from collections import Counter

import numpy as np
from llm_cases import rows
from pyspark.sql import functions as F

from strata.llm import common, cotraining, quality_crf, secrets


def test_copies_are_numbered_across_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), (None, 20), ("c", 5), ("d", 10)], "k string, n long")
    got = common.expand_copies(df, "n", "i", block=5).collect()
    assert Counter((r["k"], r["i"]) for r in got) == Counter((k, i) for k, n in df.collect() for i in range(n))
    assert common.expand_copies(df.limit(0), "n", "i").collect() == []


def test_copies_beyond_the_size_of_an_array(spark):
    """Three billion equal rows: one array of them can't be built, blocks of them can."""
    df = spark.createDataFrame([("hot", 3_000_000_000)], "k string, n long")
    assert len(common.expand_copies(df, "n", "i").take(5)) == 5
    starts = common.expand_copies(df.withColumn("n", F.lit(3_000_000).cast("bigint")), "n", "i")
    assert starts.agg(F.count_distinct("i"), F.max("i")).first()[:] == (3_000_000, 2_999_999)


def test_samples_are_the_first_by_hash(spark):
    df = spark.range(5000).select("id", (F.col("id") % 5 > 0).alias("c")).withColumn("h", F.xxhash64("id"))
    got = common.first_by_hash(df, "c", ["h", "id"], 300).collect()
    every = sorted((r["c"], r["h"], r["id"]) for r in df.collect())
    expected = [x for c in (False, True) for x in [y for y in every if y[0] == c][:300]]
    assert sorted((r["c"], r["h"], r["id"]) for r in got) == expected
    assert Counter(r["r"] for r in got) == Counter(list(range(1, 301)) * 2)


def test_samples_are_limited_before_the_shuffle(spark):
    common.prepare(spark)
    df = spark.range(100_000).select("id", (F.col("id") % 2).alias("c"), F.xxhash64("id").alias("h"))
    plan = common.first_by_hash(df, "c", ["h", "id"], 4000)._jdf.queryExecution().executedPlan().toString()
    for default in (secrets.fit.__defaults__, quality_crf.fit.__defaults__, cotraining.fit.__defaults__):
        assert max(x for x in default if isinstance(x, int) and x < 50_000) <= common.GROUP_LIMIT
    assert plan.count("WindowGroupLimit") == 4  # partial and final, in both levels


def test_ties_and_nulls_in_samples(spark):
    docs = [(r[0],) for r in rows()]
    df = spark.createDataFrame(docs, "id long").select("id", F.lit("c").alias("c"), F.lit(1).alias("h"))
    got = [r["id"] for r in common.first_by_hash(df, "c", ["h", "id"], 3).orderBy("r").collect()]
    assert got == [None, 0, 1]


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    ids = rng.integers(-(2**63), 2**63, 500)
    for x in (ids, np.sort(ids), np.zeros(0, dtype=np.int64), np.array([-1]), np.array([2**63 - 1, -(2**63)]), rng.poisson(1, 500)):
        assert (common.unpack(common.pack(x)) == x).all()
    own, index = common.unpack_ids(common.pack_ids(np.repeat(ids, 3)))
    assert (own[index] == np.repeat(ids, 3)).all() and (np.diff(own.astype(object)) > 0).all()
    assert len(common.pack(np.ones(10_000))) < 200
