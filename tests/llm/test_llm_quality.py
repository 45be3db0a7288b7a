from __future__ import annotations

import itertools
import random

import numpy as np
from llm_cases import prose
from pyspark.sql import functions as F

from strata.llm import cotraining, quality_crf

SF = "/root/testdata/sf0.01"


def _score(crf, x, labels):
    total = crf.begin[labels[0]] + sum(x[t] @ crf.emit[:, s] for t, s in enumerate(labels))
    return total + sum(crf.move[a, b] for a, b in zip(labels, labels[1:], strict=False))


def test_viterbi_against_all_label_sequences():
    rng = np.random.default_rng(4)
    crf = quality_crf.LineCrf(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    lengths = np.array([1, 4, 7, 2, 4])
    x = rng.normal(size=(lengths.sum(), 3))
    got = quality_crf.viterbi(crf, x, lengths)
    for a, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        best = max(itertools.product((0, 1), repeat=int(n)), key=lambda s: _score(crf, x[a : a + n], s))
        assert tuple(got[a : a + n]) == best


def test_training_gradient_reaches_the_optimum():
    """At the optimum the expected counts equal the observed ones (up to the penalty)."""
    rng = np.random.default_rng(5)
    lengths = np.array([3] * 60)
    labels = np.repeat(rng.integers(0, 2, 60), 3)
    x = np.column_stack([np.ones(180), labels * 2 - 1 + rng.normal(size=180)])
    crf = quality_crf.train(x, labels, lengths, steps=400)
    assert (quality_crf.viterbi(crf, x, lengths) == labels).mean() > 0.9
    assert crf.move[0, 0] > crf.move[0, 1] and crf.move[1, 1] > crf.move[1, 0]


def test_line_labels_decide_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    crf = quality_crf.fit(docs, labels.where("doc_id % 2 = 0"))
    out = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").select(
        "quality", quality_crf.assess(crf, F.col("text"), spark).alias("r")
    )
    out = out.select("quality", "r.*").toPandas()
    out = out[~out["base_failed"]]
    assert ((out["quality"] == 1) == out["kept"]).mean() > 0.97


def test_mixed_document_keeps_by_content_share(spark):
    crf = quality_crf.fit(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")))
    rng = random.Random(3)
    good = "\n".join(prose("en", 12, rng).capitalize() + "." for _ in range(20))
    bad = "\n".join(f"menu{k} | item{k} | other{k} | more{k} | last{k} |" for k in range(3))
    docs = spark.createDataFrame([(good + "\n" + bad,)], "text string")
    r = docs.select(quality_crf.assess(crf, F.col("text"), spark).alias("r")).first()["r"]
    assert r["kept"] and r["n_boilerplate"] == 3 and 0.8 < r["content_share"] < 1


def test_without_labels_the_base_rules_decide(spark):
    docs = spark.createDataFrame([(1, "word " * 60), (2, " ".join(map(str, range(60))))], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_crf.fit(docs, labels) is None
    out = docs.select("doc_id", quality_crf.assess(None, F.col("text"), spark)["kept"].alias("kept")).collect()
    assert dict(map(tuple, out)) == {1: False, 2: True}


def test_cotraining_on_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = cotraining.fit(docs, labels.where("doc_id % 2 = 0"))
    unseen = docs.join(labels.where("doc_id % 2 = 1"), "doc_id")
    out = unseen.select("quality", cotraining.quality(model, unseen).alias("r")).select("quality", "r.*").toPandas()
    assert ((out["quality"] == 1) == out["kept"]).mean() > 0.97
    assert out[["text_score", "meta_score", "score"]].map(lambda p: 0 <= p <= 1).all(axis=None)


def test_views_teach_each_other():
    """A view with three labelled rows of its own gets good from the other's pseudo-labels."""
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 2000).astype(float)
    strong, weak = (y * 2 - 1)[:, None] * 3 + rng.normal(size=(2000, 2)), (y * 2 - 1)[:, None] + rng.normal(size=(2000, 30))
    few = np.r_[np.flatnonzero(y == 1)[:12], np.flatnonzero(y == 0)[:12]]
    few = few[rng.permutation(len(few))]
    rest = np.setdiff1d(np.arange(2000), few)
    start = (strong[few], weak[few])
    alone = cotraining.cotrain(start, y[few], (strong[:0], weak[:0]))
    taught = cotraining.cotrain(start, y[few], (strong[rest], weak[rest]), exchange=300)
    error = [((m.scores(strong[rest], weak[rest])[1] > 0.5) != (y[rest] == 1)).mean() for m in (alone, taught)]
    assert error[1] <= error[0]


def test_cotraining_without_a_class(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "en", 3), (2, None, None, None, None)], "doc_id long, text string, source string, lang string, n_chars long")
    model = cotraining.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    out = docs.select(cotraining.quality(model, docs).alias("r")).select("r.*").collect()
    assert all(r["kept"] for r in out)


def test_all_unlabelled_documents_take_part(spark):
    """What only unlabelled documents show is learned from all of them, and their number is not capped."""
    seen = {}
    real = cotraining._pool_sums

    def pool_sums(pool, past, weights, sure):
        seen["rows"] = pool.count()
        out = real(pool, past, weights, sure)
        seen["taught"] = max(seen.get("taught", 0.0), out[1][weights[1].size - 1, -1])
        return out

    rng = np.random.default_rng(5)
    good, bad = ["The quiet river runs past old stone houses, and people walk there. "], ["BUY!!! CHEAP | CLICK!!! WIN | BUY!!! "]
    docs, labels = [], []
    for i in range(9000):
        q = int(rng.integers(2))
        docs.append((i, (good if q else bad)[0] * int(rng.integers(1, 4)), f"s{q}" if i < 400 else f"rare{q}", "en", 100))
        if i < 400:
            labels.append((i, q))
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long")
    cotraining._pool_sums = pool_sums
    try:
        model = cotraining.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"), rounds=1)
    finally:
        cotraining._pool_sums = real
    assert seen["rows"] == 8600
    probe = spark.createDataFrame([(1, None, "rare1", "en", 100), (2, None, "rare0", "en", 100)], df.schema)
    score = {r["doc_id"]: r["meta_score"] for r in probe.select("doc_id", cotraining.quality(model, probe).alias("r")).select("doc_id", "r.*").collect()}
    assert score[1] > 0.9 and score[2] < 0.1


def test_repeated_rows_of_a_picked_document_count_once(spark):
    """Of both fits: a document held by many rows brings one row to the driver."""
    rng = np.random.default_rng(3)
    docs = [(i, "A calm text with words, and more of them.\nSecond line here.\n" if i % 2 else "HOME | LOGIN | BUY!!!\nMENU | NEXT\n", "s", "en", 40) for i in range(80)]
    docs = [(i, t + f"w{rng.integers(10**6)}", *r) for i, t, *r in docs]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    once, often = (spark.createDataFrame(d, schema) for d in (docs, docs + [docs[7]] * 500))
    a, b = (cotraining.fit(d, labels, rounds=1) for d in (once, often))
    assert all(np.allclose(x.weights, y.weights) for x, y in zip(a.views, b.views, strict=True))
    a, b = (quality_crf.fit(d.select("doc_id", "text"), labels) for d in (once, often))
    assert np.allclose(a.emit, b.emit)
