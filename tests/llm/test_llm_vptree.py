from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import vptree

SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(n: int, dim: int, rng: random.Random, copies: int = 0):
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)], i % 3) for i in range(n)]
    hot = rows[0][1]
    return rows + [(n + i, list(hot), 0) for i in range(copies)]


def _brute(rows, k, every):
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v, _ in rows}
    out = {}
    for q, v in vectors.items():
        if q % every == 0:
            near = [(-float(np.cumsum(v * w)[-1]), i) for i, w in vectors.items() if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard_rows", [10_000, 37])
def test_factor_one_is_exact_with_copies_and_ties(spark, shard_rows):
    rows = _rows(150, 6, random.Random(3), copies=60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = _found(vptree.nearest(df, F.col("vec_id") % 5 == 0, k=7, shard_rows=shard_rows, query_rows=11))
    assert got == _brute(rows, 7, 5)


def test_shards_bounded_by_bytes_lanes_and_shared_partitions(spark, monkeypatch):
    """Long vectors make smaller shards; every lane gets the shard's tree; a task may have several trees in turn."""
    monkeypatch.setattr(vptree, "SHARD_BYTES", 20 * 8 * 7)
    monkeypatch.setattr(vptree, "LANE", 2)
    monkeypatch.setattr(vptree, "SEARCHES", 3)
    rows = _rows(120, 6, random.Random(5), copies=30) + [(k, v, w) for k, v, w in _rows(9, 3, random.Random(6))]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    got = _found(vptree.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 2 == 0, k=5, query_rows=9))
    expected = {}
    for dim in (6, 3):
        expected |= _brute([r for r in rows if len(r[1]) == dim], 5, 2)
    assert got == expected


def test_fewer_candidates_than_k(spark):
    rows = _rows(4, 3, random.Random(1))
    got = _found(vptree.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") >= 0, k=20))
    assert got == _brute(rows, 20, 1)


def test_vectors_that_take_no_part(spark):
    good = _rows(20, 4, random.Random(2))
    bad = [
        (100, None, 0),
        (101, [0.0] * 4, 0),
        (102, [1.0, None, 0.0, 0.0], 0),
        (103, [math.nan, 1.0, 1.0, 1.0], 0),
        (104, [math.inf, 1.0, 1.0, 1.0], 0),
        (105, [], 0),
        (None, [1.0, 2.0, 3.0, 4.0], 0),
        (106, [1.0, 2.0], 0),  # of another length: nothing to compare with
    ]
    twice = [good[5], good[5]]  # repeated rows count once
    df = spark.createDataFrame(good + bad + twice, SCHEMA).repartition(4)
    got = _found(vptree.nearest(df, F.col("vec_id") >= 0, k=5))
    assert got == _brute(good, 5, 1)


def test_empty_table(spark):
    assert vptree.nearest(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0


def test_relaxed_pruning_visits_less():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    tree = vptree.build(x, leaf=16)
    exact, relaxed = (vptree._Search(tree, x[:100], 8, f) for f in (1.0, 0.8))
    recall = np.mean([len(set(a) & set(b)) / 8 for a, b in zip(exact.found, relaxed.found, strict=True)])
    assert relaxed.visited < exact.visited < 100 * 4000
    assert 0.85 < recall < 1


@pytest.mark.parametrize("seed", [1, 2])
def test_ties_of_many_distinct_vectors_go_to_the_smaller_id(spark, seed):
    """One-hot and quantised vectors: hundreds share the product at the border."""
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        v = [0.0] * 40
        v[i % 40] = 1.0 + i // 40  # one-hot, of different lengths: all products are 0 but a few
        rows.append((i, v, 0))
    rows += [(300 + i, [float(rng.randint(-1, 1)) for _ in range(40)], 0) for i in range(100)]
    rng.shuffle(rows)
    rows = [(k, v, 0) for k, (_, v, _) in enumerate(rows) if any(v)]
    got = _found(vptree.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 4 == 0, k=10))
    assert got == _brute(rows, 10, 4)


def test_one_huge_norm_does_not_blur_the_others(spark):
    rows = _rows(600, 8, random.Random(9))
    rows.append((600, [1e8] + [0.0] * 7, 0))
    got = _found(vptree.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 7 == 0, k=5))
    assert got == _brute(rows, 5, 7)
