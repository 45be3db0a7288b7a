from __future__ import annotations

import math
import pathlib
import re
import zlib
from collections import Counter

import numpy as np
from llm_cases import table
from pyspark.sql import functions as F

from strata.llm import pitman_yor, queries
from strata.session import checkpoint_root

SF = "/root/testdata/sf0.001"


def test_seating_keeps_its_books():
    rng = np.random.default_rng(1)
    customers = rng.integers(1, 400, 50)
    seating = pitman_yor.Seating(customers, np.full(50, 0.3), 0.6, rng)
    for _ in range(30):
        d = np.flatnonzero(seating.c > 1)
        seating.remove(d)
        seating.add(d, np.full(len(d), 0.3))
    assert (seating.c == customers).all()
    assert (np.bincount(seating.dish, weights=seating.size) == customers).all()
    assert (np.bincount(seating.dish, minlength=50) == seating.t).all()
    assert (np.diff(seating.dish) >= 0).all() and (seating.size > 0).all()


def test_gibbs_steps_reach_the_restaurant_s_law():
    """One dish of 6 customers: the mean number of tables is that of the process itself."""
    discount, weight, customers = 0.5, 0.8, 6
    law = Counter({1: 1.0})  # tables after the first customer
    for c in range(1, customers):
        step = Counter()
        for t, p in law.items():
            new = weight / (weight + c - discount * t)
            step[t + 1] += p * new
            step[t] += p * (1 - new)
        law = step
    # A fixed weight of a new table makes the seating exchangeable only with the weights of its own law.
    rng = np.random.default_rng(2)
    seating = pitman_yor.Seating(np.full(4000, customers), np.full(4000, weight), discount, rng)
    before = seating.t.mean()
    for _ in range(40):
        d = np.arange(4000)
        seating.remove(d)
        seating.add(d, np.full(4000, weight))
    expected = sum(t * p for t, p in law.items())
    assert abs(before - expected) < 0.5 and abs(seating.t.mean() - expected) < 0.5


def _model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    return pitman_yor.fit(docs)


def test_probabilities_sum_to_one_in_every_context(spark):
    model = _model(spark)
    buckets = [pitman_yor._Words(r, model.samples) for r in model.state.collect()]
    unknown = np.int64(-(1 << 60)) & ~np.int64(pitman_yor.CLASSES - 1)
    for context in (0, 1, 7, 31):
        total = sum(b.look_up(b.words | context)[1].sum() for b in buckets)
        total += buckets[0].look_up(np.array([unknown | context]))[1][0]
        assert abs(total - 1) < 1e-9


def test_base_score_and_counts_against_brute_force(spark, stored_tables):
    path = stored_tables()
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    lowered = [(i, re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")) for i, t in docs]
    tokens = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", t), None]) for i, t in lowered]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = Counter(
        (i, held(i), len(ws), sum(counts[w] > 0 for w in ws), round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4))
        for i, ws in tokens
    )
    out = queries.QUERIES["op8_pitman_yor"](spark, path).collect()
    assert {r["train_tokens"] for r in out} == {n}
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in out) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)


def test_frequent_words_and_buckets_give_the_same_scores(spark, monkeypatch):
    """Whether a word is sent to the tasks or met in its bucket, its probability is the same."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 80").select("doc_id", "text")
    model = pitman_yor.fit(docs.where("doc_id % 3 > 0"))
    runs = []
    for most in (100_000, 10, 0.5):
        monkeypatch.setattr(pitman_yor, "MAX_FREQUENT", most)
        runs.append({r["doc_id"]: (r["n_known"], r["score"]) for r in pitman_yor.score(model, docs).collect()})
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 500)  # salted buckets
    runs.append({r["doc_id"]: (r["n_known"], r["score"]) for r in pitman_yor.score(model, docs).collect()})
    for other in runs[1:]:
        assert all(other[i][0] == k and abs(other[i][1] - s) < 1e-6 * abs(s) for i, (k, s) in runs[0].items())


def test_better_than_the_base_on_unseen_texts(spark):
    out = queries.QUERIES["op8_pitman_yor"](spark, SF).where("held_out")
    r = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > 0.95 * r["b"]


def test_no_training_text(spark):
    docs = table(spark).select("doc_id", "text")
    model = pitman_yor.fit(docs.where("false"))
    out = pitman_yor.score(model, docs).collect()
    assert len(out) == docs.count() and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)


def test_contexts_are_the_preceding_words(spark):
    """Two words with the same last three bytes foretell different words."""
    rows = [("big kettle boils",)] * 300 + [("big nettle stings",)] * 300
    model = pitman_yor.fit(spark.createDataFrame(rows, "text string"))
    docs = spark.createDataFrame([(0, "kettle boils"), (1, "kettle stings"), (2, "nettle stings"), (3, "nettle boils")], "doc_id long, text string")
    for most in (100_000, 0.5):
        with_most, pitman_yor.MAX_FREQUENT = pitman_yor.MAX_FREQUENT, most
        p = {r["doc_id"]: r["score"] for r in pitman_yor.score(model, docs).collect()}
        pitman_yor.MAX_FREQUENT = with_most
        assert p[0] > p[1] + 1 and p[2] > p[3] + 1
    contexts = sum(len(r["contexts"]) // 8 for r in model.contexts.collect())
    assert contexts == 6  # the start, and five words


def test_probabilities_of_all_words_sum_to_one_after_real_words(spark):
    model = _model(spark)
    words = np.concatenate([pitman_yor._Words(r, model.samples).words for r in model.state.collect()])
    bucket = {r["bucket"]: r for r in model.state.collect()}
    part = {r["part"]: r for r in model.contexts.collect()}
    contexts = np.concatenate([np.frombuffer(r["contexts"], dtype=np.int64) for r in part.values()])[:5]
    for context in contexts:
        row = next(r for r in part.values() if context in np.frombuffer(r["contexts"], dtype=np.int64))
        at = np.frombuffer(row["contexts"], dtype=np.int64).tolist().index(context)
        weight = np.frombuffer(row["weight"]).reshape(len(model.samples), -1)[:, at]
        total, unknown = 0.0, None
        for b in bucket.values():
            known = pitman_yor._Words(b, model.samples)
            of_class = known.by_sample(known.words | (context & (pitman_yor.CLASSES - 1)))
            own = dict(zip(np.frombuffer(b["pairs"], dtype=np.int64).tolist(), np.frombuffer(b["p"]).tolist(), strict=True))
            pairs = pitman_yor._pair(known.words, np.full(len(known.words), context))
            total += sum(own.get(i, x) for i, x in zip(pairs.tolist(), weight @ of_class / len(weight), strict=True))
            unknown = known.by_sample(np.array([np.int64(-(1 << 60)) & ~np.int64(31) | (context & 31)]))[:, 0]
        total += float(weight @ unknown) / len(weight)
        assert abs(total - 1) < 1e-9
    assert len(words) == model.v


def _law(customers, others, p, discount):
    """Tables of a dish by adding its customers one by one; the weight of a seating is a product over its tables."""
    ways = {1: 1.0}
    for c in range(1, customers):
        step = Counter()
        for t, w in ways.items():
            step[t + 1] += w
            step[t] += w * (c - discount * t)
        ways = step
    law = {}
    for t, w in ways.items():
        law[t] = w * math.prod((pitman_yor.STRENGTH + discount * (others + k)) * p for k in range(t))
    return {t: x / sum(law.values()) for t, x in law.items()}


def test_a_sweep_reseats_all_customers_by_their_law(monkeypatch):
    rng = np.random.default_rng(3)
    n = 40_000
    args = np.full(n, 7.0), np.full(n, 0.2), np.full(n, 1e-9), np.zeros(n), 0.6
    law = _law(12, 7, 0.2, 0.6)
    t = pitman_yor.draw_tables(np.full(n, 12), *args, rng)
    assert all(abs((t == k).mean() - p) < 0.012 for k, p in law.items())
    # The integral for many customers gives the tabulated law.
    monkeypatch.setattr(pitman_yor, "EXACT", 64)
    for discount in (0.1, 0.5, 0.9):
        pitman_yor._log_ways.cache_clear()
        n = 4000
        args = np.full(n, 100.0), np.full(n, 0.05), np.full(n, 1e-9), np.zeros(n), discount
        law = _law(150, 100, 0.05, discount)
        t = pitman_yor.draw_tables(np.full(n, 150), *args, rng)
        mean = sum(k * p for k, p in law.items())
        assert abs(t.mean() - mean) < 0.25 and all(abs((t == k).mean() - p) < 0.04 for k, p in law.items())
    pitman_yor._log_ways.cache_clear()


def test_tables_of_hot_dishes_move_in_every_sweep():
    """Dishes of a million customers: their tables are drawn anew, not four customers of them."""
    word, context = np.array([32 * 5] * 2), np.array([32 * 9 + 1, 32 * 11 + 1])
    tables = np.full(pitman_yor.CLASSES, 1e5)
    totals = pitman_yor.Totals(10**8, 10**5, np.full(pitman_yor.CLASSES, 5e6), 0.6, 0.4, tables, 1e5, 0.7)
    seen = set()
    for seed in range(4):
        at = pitman_yor.Bucket(word, context, np.array([1_000_000] * 2))
        at.t[1] = 40_000  # the word has about one hundredth of the class
        at.sweep(totals, np.array([50_000] * 2), np.random.default_rng(seed))
        seen.add(int(at.t[0]))
    assert len(seen) > 1 and min(seen) > 10


def test_counts_are_stored_once_and_never_shuffled_again(spark):
    """Learning and scoring store about twice the text (they stored twelve times it); counts meet messages where they lie."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    root = pathlib.Path(checkpoint_root(spark).removeprefix("file:")) / "llm"
    before = set(root.rglob("*.parquet"))
    model = pitman_yor.fit(docs)
    pitman_yor.score(model, docs).collect()
    stored = sum(f.stat().st_size for f in set(root.rglob("*.parquet")) - before)
    assert stored < 4 * docs.agg(F.sum(F.octet_length("text"))).first()[0]
    plan = model.state._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1  # the messages


def test_sorted_pairs_with_equal_upper_bits():
    """Contexts that only differ in their lower bits are told apart, and negative ones come first."""
    words = np.array([64, 32, 64, 32, 64, 32], dtype=np.int64)
    contexts = np.array([7, -5, 3, 9, 7, -5], dtype=np.int64)
    got = pitman_yor._summed(words, contexts, np.ones(6, dtype=np.int64))
    assert [x.tolist() for x in got] == [[32, 32, 64, 64], [-5, 9, 3, 7], [2, 1, 1, 2]]
