"""Every query takes awkward rows, empty tables and clashing columns; what SQL expresses equals its oracle."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest
from llm_cases import WORD, rows
from oracle_harness import compare, duck

from strata.llm import queries

SF = "/root/testdata/sf0.001"
ON_VECTORS = ("op7_vp_tree", "op13_whitening")
PER_WORD = ("op12_edit_transducer",)
ON_DOCUMENTS = [q for q in sorted(queries.QUERIES) if q not in ON_VECTORS + PER_WORD]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    ok, message = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert ok, message


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_awkward_rows(spark, stored_tables, name):
    out = queries.QUERIES[name](spark, stored_tables()).toPandas()
    ids = Counter(-1 if i is None else i for i, *_ in rows())
    assert Counter(out["doc_id"].fillna(-1).astype(int)) == ids


@pytest.mark.parametrize("name", ON_DOCUMENTS + list(PER_WORD))
def test_empty_table(spark, stored_tables, name):
    assert queries.QUERIES[name](spark, stored_tables([])).count() == 0


@pytest.mark.parametrize("name", ON_DOCUMENTS + list(PER_WORD))
def test_reruns_agree(spark, name):
    runs = [sorted(map(str, queries.QUERIES[name](spark, SF).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def _texts(spark, path):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}


def test_secret_digest(spark, stored_tables):
    """Base spans from the contract's own patterns, applied one by one."""
    path = stored_tables()
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rules = [("assign", assign, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    texts = _texts(spark, path)
    for r in queries.QUERIES["op2_secrets"](spark, path).collect():
        found = [
            (m.start(), k, kind, m.end())
            for k, (kind, rule, group, least) in enumerate(rules)
            for m in rule.finditer(texts[r["doc_id"]] or "")
            if len(m.group(group)) >= least
        ]
        spans = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(f[1] == k for f in found) for k in range(3))
        assert set(spans.split(",")) <= set(r["spans"].split(",")) or not spans


def test_quality_counts(spark, stored_tables):
    path = stored_tables()
    texts = _texts(spark, path)
    for r in queries.QUERIES["op3_quality_rules"](spark, path).collect():
        text = texts[r["doc_id"]] or ""
        words = WORD.findall(text)
        windows = list(zip(words, words[1:], words[2:], strict=False))
        times = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        expected = (
            len(words),
            sum(map(len, words)),
            len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)),
            len(covered),
        )
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_sharding_law(spark, stored_tables):
    path = stored_tables()
    texts = _texts(spark, path)
    out = queries.QUERIES["op4_sharding"](spark, path).toPandas()
    sizes = out.groupby("shard")["slot"].agg(["count", "min", "max"])
    assert sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["count"] - 1).all()
    for i, size, crc in zip(out["doc_id"], out["size"], out["text_crc32"], strict=True):
        raw = (texts[None if i != i else int(i)] or "").encode()
        assert (size, crc) == (len(raw) + 1, zlib.crc32(raw))


def test_language_of_texts_without_letters(spark, stored_tables):
    out = {r["doc_id"]: r for r in queries.QUERIES["op1_language_id"](spark, stored_tables()).collect()}
    for i in (100, 101, 102, 108):
        assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert {r["lang_pred"] for r in out.values()} <= {"en", "de", "fr", "und"}


def test_sentencepiece_equals_the_library(spark, stored_tables):
    import sentencepiece

    from strata.llm.sentencepieces import DEFAULT_MODEL

    sp = sentencepiece.SentencePieceProcessor(model_file=DEFAULT_MODEL)
    path = stored_tables()
    texts = _texts(spark, path)
    for r in queries.QUERIES["op10_sentencepiece"](spark, path).collect():
        text = texts[r["doc_id"]]
        assert r["ids"] == (None if text is None else sp.encode(text))
        assert r["round_trip"] is (None if text is None else True)
