from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(n=200, d=7, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    return [(i, [float(c) for c in np.float32(v)], 0) for i, v in enumerate(x)]


def _expected(rows, k):
    x = {i: np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) for i, v, _ in rows}
    listed = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(listed), listed.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(listed.T, bias=True))
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = {i: (v - s / n) @ vectors / np.sqrt(values) for i, v in x.items()}
    return n, {i: int(((n * v - s) ** 2).sum()) for i, v in x.items()}, white, values / np.trace(np.cov(listed.T, bias=True))


def _check(df, rows, k=4):
    n, deviation, white, explained = _expected(rows, k)
    out = whitening.whiten(whitening.fit(df, k), df).collect()
    assert len(out) == k * len(rows)
    got = {}
    for r in out:
        assert (r["n"], r["deviation"]) == (n, deviation[r["vec_id"]])
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        assert r["identity_error"] < 1e-9
        got.setdefault(r["component"], {}).setdefault(r["vec_id"], r["whitened"])
    for c, by_id in got.items():
        a = np.array([by_id[i] for i in sorted(by_id)])
        b = np.array([white[i][c - 1] for i in sorted(by_id)])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_against_the_library(spark):
    rows = _rows()
    copies = [(1000 + i, rows[3][1], 0) for i in range(300)]  # one vector of the fit list, each a row
    _check(spark.createDataFrame(rows + copies, SCHEMA).repartition(5), rows + copies)


def test_rows_that_take_no_part(spark):
    rows = _rows(60, 4)
    bad = [
        (900, None, 0),
        (901, [1.0, None, 2.0, 3.0], 0),
        (902, [math.nan, 1.0, 1.0, 1.0], 0),
        (903, [1.0, 1.0, -math.inf, 1.0], 0),
        (904, [], 0),
        (905, [1.0, 2.0], 0),  # of another length
    ]
    df = spark.createDataFrame(rows + bad + [rows[0]], SCHEMA).repartition(3)
    out = whitening.whiten(whitening.fit(df), df.withColumns({"n": F.lit("x"), "component": F.lit(0)}))
    assert out.count() == 4 * 61
    assert {r[0] for r in out.select("vec_id").collect()} == {i for i, _, _ in rows}


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(whitening.fit(empty), empty).count() == 0
    equal = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)] + [(None, [1.0, 2.0], 0)], SCHEMA)
    assert whitening.whiten(whitening.fit(equal), equal).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 0) for i in range(9)], SCHEMA)
    assert {r[0] for r in whitening.whiten(whitening.fit(flat), flat).select("component").collect()} == {1}
    huge = spark.createDataFrame([(i, [3e37 * i, 1.0 * i * i], 0) for i in range(9)], SCHEMA)
    assert {r[0] for r in whitening.whiten(whitening.fit(huge), huge).select("deviation").collect()} == {None}


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 1, 1, 0], [9, 4, 1], [3, 3], [2], [1, 1 + 1e-12, 1 - 1e-12, 0.5], [4, 0, 0, 0]])
def test_eigenvectors_of_clusters(spectrum):
    rng = np.random.default_rng(len(spectrum))
    q, _ = np.linalg.qr(rng.normal(size=(len(spectrum),) * 2))
    v = (q * np.array(spectrum)) @ q.T
    v = (v + v.T) / 2
    values, units = whitening.principal(v, 4)
    assert values == pytest.approx(sorted(spectrum, reverse=True)[:4], abs=1e-12)
    assert np.abs(units.T @ units - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ units - units * values).max() < 1e-12


def test_sturm_counts():
    rng = np.random.default_rng(3)
    d, e = rng.normal(size=20), rng.normal(size=19)
    e[4] = 0  # two blocks
    exact = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    for x in np.linspace(-4, 4, 33):
        assert whitening.count_below(d, e, x) == (exact < x).sum()
    t, s, q = whitening.tridiagonal(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    assert np.abs(q @ (np.diag(t) + np.diag(s, 1) + np.diag(s, -1)) @ q.T - np.diag(d) - np.diag(e, 1) - np.diag(e, -1)).max() < 1e-12


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], 0) for r in vectors]
    n, deviation, _, explained = _expected(rows, 4)
    out = queries.QUERIES["op13_whitening"](spark, sf).collect()
    assert len(out) == 4 * len(rows)
    assert all((r["n"], r["deviation"]) == (n, deviation[r["vec_id"]]) for r in out)
    assert all(r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9) for r in out)
