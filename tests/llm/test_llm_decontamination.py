from __future__ import annotations

import random
import re

import pytest
from llm_cases import CLASHING, rows
from pyspark.sql import functions as F

from strata.llm import decontamination as dec

WORDS = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return WORDS.findall((text or "").translate(AZ))


def brute(docs, items, window=dec.WINDOW):
    """Every window of every item looked for at every place of every document."""
    cut = [(str("" if i is None else i), words(t)) for i, t in items]
    cut = [(i, w, min(window, len(w))) for i, w in cut if w]
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, v, k in cut:
            own = {tuple(v[s : s + k]) for s in range(len(v) - k + 1)}
            for s in range(len(w) - k + 1):
                if tuple(w[s : s + k]) in own:
                    hit.update(range(s, s + k))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(df):
    out = []
    for r in df.collect():
        assert sum(s["past"] - s["first"] for s in r["spans"]) == r["n_hit"]
        assert all(a["past"] < b["first"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))
        out.append((r["doc_id"], r["n_words"], r["n_hit"], r["items"]))
    return sorted(out, key=str)


def check(spark, docs, items, window=dec.WINDOW):
    found = dec.contamination(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS).repartition(2), window
    )
    assert got(found) == brute(docs, items, window)
    return found


def test_shared_runs_of_every_length(spark):
    rng = random.Random(5)
    item = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(item)), (2, " ".join(item[5:25])), (2, " ".join(item[30:])), (10, "alone " * 12)]
    docs = []
    for n in range(7, 16):  # a shared run of n words at every place of the item
        for s in range(0, 40 - n, 3):
            before, after = ([f"x{rng.randint(0, 9)}" for _ in range(rng.randint(0, 6))] for _ in range(2))
            docs.append((len(docs), " ".join([*before, *item[s : s + n], *after])))
    found = check(spark, docs, items)
    reached = {r["doc_id"]: r["n_hit"] for r in found.collect()}
    assert any(v for v in reached.values()) and any(not v for v in reached.values())


@pytest.mark.parametrize("window", [1, 2, 3, 5, 10])
def test_few_letters_against_all_windows(spark, window):
    rng = random.Random(window)

    def text(n):
        return " ".join(rng.choices("a b c".split(), k=n))

    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    items = [(i, text(rng.randint(0, 14))) for i in range(8)]
    check(spark, docs, items, window)


def test_short_items_and_case(spark):
    docs = [
        (1, "One TWO three; É é Kelvin\u212A k one"),
        (2, "one-two x one two"),
        (3, "ONE"),
        (None, None),
        (4, ""),
        (4, "..."),
        (5, "é"),
        (5, "é"),
    ]
    items = [(7, "one two"), (8, "É"), (9, "kelvink"), (None, "three"), (3, None), (4, " . "), (10, "one")]
    check(spark, docs, items)


def test_awkward_rows_clashing_names_and_empty_tables(spark):
    docs = [(i, t) for i, t, _, _ in rows()]
    items = [(1, docs[2][1]), (2, docs[40 + 8][1][:3000]), (1, "漢字 😀")]
    extra = [(i, t, 0.5, False, "r", 7, 8, 0.25, 9, 10, "s", 3) for i, t in docs]
    wide = spark.createDataFrame(extra, f"{DOCS}, {CLASHING}").withColumns({"f": F.lit(1), "length": F.lit(2), "words": F.lit("w")})
    bench = spark.createDataFrame(items, ITEMS).withColumns({"f": F.lit(1), "length": F.lit(2), "item": F.lit("w")})
    assert got(dec.contamination(wide, bench)) == brute(docs, items)
    assert dec.contamination(wide.limit(0), bench).count() == 0
    assert got(dec.contamination(wide, bench.limit(0))) == brute(docs, [])


def test_full_bit_table_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(dec, "TABLE_WORDS", 2)
    rng = random.Random(9)
    item = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(item, k=50) + item[i : i + 12])) for i in range(20)]
    check(spark, docs, [(1, " ".join(item))])


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c")], DOCS)
    plan = dec.contamination(docs, spark.createDataFrame([(1, "a b")], ITEMS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)
