from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import rows, table

from strata.llm import queries, spelling

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts):
    """All pairs of words."""
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= spelling.FORM_RATIO * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    full = {}
    for w, (form, n, k, m) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        full[w] = (form, root, n, k, m)
    return full


def found(spark, counts, **sizes):
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(3)
    out = spelling.forms(spelling.neighbours(words, **sizes)).collect()
    assert len(out) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}


@pytest.mark.parametrize("part_words,bucket_rows", [(1 << 15, 1 << 16), (4, 50), (1, 7)])
def test_pairs_against_all_pairs(spark, part_words, bucket_rows):
    rng = random.Random(part_words)
    counts = {"".join(rng.choices("abé", k=rng.randint(3, 8))): rng.choice([5, 5, 30, 200, 2000]) for _ in range(150)}
    assert found(spark, counts, part_words=part_words, bucket_rows=bucket_rows) == brute(counts)


def test_large_partitions_are_cut(spark):
    base = "abcdefghij"
    counts = {base[:i] + c + base[i + 1 :]: 5 + i for i in range(10) for c in "klmnop"} | {base: 1000}
    words = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    rows = spelling.partitions(words, part_words=8)
    sizes = rows.groupBy(*spelling._PART).count().where("hi - lo > 1")
    assert sizes.where("count > 8").count() == 0
    assert found(spark, counts, part_words=8) == brute(counts)


def test_long_words_ties_and_chains(spark):
    long = "xy" * 3000
    counts = {
        long: 100,
        long[:-1]: 5,
        "aaaaaa": 5,
        "aaaaaaa": 25,
        "aaaaaaab": 125,
        "aaaaaaabc": 625,
        "bbbbbb": 5,
        "bbbbba": 25,
        "bbbbbc": 25,
        "ÿÿÿÿÿÿ": 24,
        "ÿÿÿÿÿ×ÿ": 5,
    }
    got = found(spark, counts)
    assert got == brute(counts)
    assert got["aaaaaa"][1] == "aaaaaaabc" and got["bbbbbb"][0] == "bbbbba"


def test_vocabulary(spark):
    docs = [(i, t) for i, t, _, _ in rows()]
    times = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            times[run] += 1
    expected = {w: n for w, n in times.items() if len(w) >= 6 and n >= 5}
    got = {r["word"]: r["n"] for r in spelling.vocabulary(table(spark, extra=True), noise=7).collect()}
    assert got == expected and expected


def test_query_on_awkward_rows(spark, stored_tables):
    out = queries.QUERIES["op12_edit_transducer"](spark, stored_tables()).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}
    assert got == brute({w: v[2] for w, v in got.items()})


def test_minimal_acceptor_merges_equal_tails():
    """Words that differ in their first letter only have one state from there on."""
    import numpy as np

    codes = np.array([[0, first, 5, tail] for first in range(10) for tail in (7, 8, 9)])
    levels, (states, _) = spelling._minimise([spelling._Trie.of(codes), spelling._Trie.of(codes[:0, :3])])
    assert [len(x.count) for x in levels] == [1, 1, 1, 1]
    assert levels[3].count.tolist() == [30] and len(np.unique(states[2])) == 1
