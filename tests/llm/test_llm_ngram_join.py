from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import WORD, rows, table

from strata.llm import components as cc
from strata.llm import ngram_join as nj


def brute(docs: list[tuple], num: int = 75, den: int = 100) -> dict:
    """doc_id -> (set size, least linked id), by comparing all pairs."""
    sets = {}
    for i, text in docs:
        words = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
        sets.setdefault(i, {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()})
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def found(df) -> dict:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def family(rng: random.Random, start: int, n: int, size: int, edits: int) -> list[tuple]:
    """A chain of near copies, each edited from a random earlier one."""
    texts = [[f"w{rng.randrange(4000)}" for _ in range(size)]]
    for _ in range(n - 1):
        words = list(rng.choice(texts))
        for _ in range(rng.randint(0, edits)):
            if words and rng.random() < 0.7:
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            else:
                words.insert(rng.randrange(len(words) + 1), f"i{rng.randrange(10**6)}")
        texts.append(words)
    return [(start + k, " ".join(w)) for k, w in enumerate(texts)]


@pytest.mark.parametrize("group", [nj.GROUP, 2])
def test_components_against_all_pairs(spark, monkeypatch, group):
    """Near copies of all sizes, and a passage that unrelated texts share; also when almost every group is large."""
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "TILE", 5)
    rng = random.Random(group)
    docs = []
    for size in (1, 3, 5, 6, 7, 9, 12, 20, 35, 60, 130, 400):
        docs += family(rng, len(docs), 14, size, max(1, size // 25))
    passage = " ".join(f"p{k}" for k in range(60))
    for _ in range(30):
        docs.append((len(docs), " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) + " " + passage))
    docs += [(len(docs) + k, t) for k, t in enumerate([None, "", "  \n", docs[3][1], docs[3][1].upper()])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(nj.jaccard_components(df)) == brute(docs)


@pytest.mark.parametrize("num", [50, 90])
def test_other_thresholds(spark, num):
    rng = random.Random(num)
    docs = [d for k, size in enumerate((8, 30, 90)) for d in family(rng, 100 * k, 12, size, 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(nj.jaccard_components(df, num=num)) == brute(docs, num)


def test_awkward_rows(spark):
    named = [(i, t) for i, t, *_ in rows() if i is not None]
    expected = brute(named)
    got = nj.jaccard_components(table(spark, extra=True)).collect()
    assert len(got) == len(rows())
    for r in got:
        if r["doc_id"] is None:  # its text equals document 1's
            assert r["component_id"] == 1
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_linked_sets_share_a_signature(data):
    """The guarantee itself: under each kind of scheme, every linked pair has a signature in common."""
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    num = data.draw(st.sampled_from([50, 75, 90]))
    size = data.draw(st.integers(1, 300))
    base = rng.integers(1, 2**63, size, dtype=np.uint64)
    drop = data.draw(st.integers(0, max(0, size * (100 - num) // 100)))
    added = data.draw(st.integers(0, max(0, size * (100 - num) // 100)))
    x, y = np.unique(base), np.unique(np.r_[base[drop:], rng.integers(1, 2**63, added, dtype=np.uint64)])
    both = len(np.intersect1d(x, y))
    if not both or 100 * both < num * (len(x) + len(y) - both):
        return
    schemes = nj.Schemes(frozenset(), None, num, 100)
    hot = set(base[::2].tolist())
    for kind in (nj.SINGLES, nj.SUBSETS, nj.DELETIONS):
        bands = [{b: s for b, _, s, e in schemes.signatures(v, np.array([h in hot for h in v.tolist()]), defaultdict(lambda: kind))} for v in (x, y)]
        assert any(np.isin(bands[0][b], bands[1][b]).any() for b in bands[0].keys() & bands[1].keys())


def test_parity_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for size in (1, 50, 5000):
        x = np.unique(rng.integers(1, 2**63, size, dtype=np.uint64))
        y = np.unique(np.r_[x[size // 10 :], rng.integers(1, 2**63, size // 7, dtype=np.uint64)])
        apart = np.bitwise_count(np.frombuffer(nj._sketch(x), np.uint8) ^ np.frombuffer(nj._sketch(y), np.uint8)).sum()
        assert apart <= len(np.setxor1d(x, y))


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 540)]
    cycle = [(900 + k, 900 + (k + 1) % 9) for k in range(9)]
    links = chain + star + cycle + [(7, 7)]
    rng.shuffle(links)
    out = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {k: 100 for k in range(100, 161)} | {k: 500 for k in range(500, 540)} | {k: 900 for k in range(900, 909)}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("group", [nj.GROUP, 2])
def test_all_links_and_link_counts_against_all_pairs(spark, monkeypatch, group):
    """Of large groups too: 60 near copies of one text link almost all to each other, not only to one component."""
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "TILE", 9)
    rng = random.Random(group)
    words = [f"w{k}" for k in range(80)]
    docs = []
    for k in range(60):
        copy = list(words)
        copy[rng.randrange(80)] = f"e{k}"
        docs.append((k, " ".join(copy)))
    docs += family(rng, 60, 14, 30, 2) + [(74, docs[0][1]), (75, docs[0][1].upper()), (76, ""), (77, None), (78, "alone")]
    sets = {}
    for i, text in docs:
        ws = (text or "").lower().split()
        sets[i] = frozenset(tuple(ws[k : k + 5]) for k in range(len(ws) - 4)) if len(ws) >= 5 else frozenset({tuple(ws)} - {()})
    linked = lambda x, y: x != y and bool(x & y) and 100 * len(x & y) >= 75 * len(x | y)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    links, members = nj.jaccard_links(df)
    got = {r["doc_id"]: r for r in members.collect()}
    for i, s in sets.items():
        assert got[i]["n_shingles"] == len(s)
        assert got[i]["n_links"] == sum(linked(s, t) for t in sets.values())
        assert got[i]["n_equal"] == (sum(s == t for t in sets.values()) - 1 if s else 0)
    by_set = {got[i]["set_id"]: s for i, s in sets.items() if s}
    expected = {(min(a, b), max(a, b)) for a, s in by_set.items() for b, t in by_set.items() if linked(s, t)}
    rows_ = [(r["a"], r["b"]) for r in links.collect()]
    assert len(rows_) == len(set(rows_)) and {(min(p), max(p)) for p in rows_} == expected
    assert all(a < b for a, b in rows_)
