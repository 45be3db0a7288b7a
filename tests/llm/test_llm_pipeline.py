"""The stages one after another against plain Python on the same rows."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
import sentencepiece
from llm_cases import rows, table
from test_llm_ngram_join import brute

from strata.llm import secrets
from strata.llm.sentencepieces import DEFAULT_MODEL


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """(name, input, output) of every stage, each written and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs = table(spark, extra=True)
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{root}/{name}")
        result = spark.read.parquet(f"{root}/{name}")
        out.append((name, docs, result))
        docs = result
    return {name: (a.collect(), b.collect(), b.columns) for name, a, b in out}


def test_columns_stay(results):
    columns = table_columns = None
    for name, (_, _, got) in results.items():
        table_columns = table_columns or got
        columns = got if name != "sentencepiece" else columns
        assert name == "sentencepiece" or got == table_columns
    assert {"doc_id", "text", "lang", "source", "n_chars", "score", "kept", "rank"} <= set(columns)


def test_language_stage_drops_texts_without_letters_only(results):
    before, after, _ = results["language_id"]
    lost = Counter(r["doc_id"] for r in before) - Counter(r["doc_id"] for r in after)
    assert set(lost) == {100, 101, 102, 108}
    assert all(r["lang"] is not None for r in after)


def test_one_document_of_each_group_stays(results):
    before, after, _ = results["near_duplicates"]
    named = [(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None]
    groups = brute(named)
    assert sorted(r["doc_id"] for r in after) == sorted({least for _, least in groups.values()})


def test_secrets_are_gone(results):
    before, after, _ = results["secrets"]
    assert len(before) == len(after)
    assert all(not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after)
    same = {r["doc_id"]: r["text"] for r in before}
    assert {r["doc_id"] for r in after if same[r["doc_id"]] != r["text"]} == {110}


def test_mixing_repeats_whole_documents(results):
    before, after, _ = results["mixing"]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(texts[r["doc_id"]] == r["text"] for r in after)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2
    words = lambda rs: sum(len(r["text"].split()) for r in rs)
    assert 1 < words(after) / words(before) < 2  # one very long text is kept or left out as a whole


def test_last_stage_encodes_every_row(results):
    before, after, _ = results["sentencepiece"]
    library = sentencepiece.SentencePieceProcessor(model_file=DEFAULT_MODEL)
    assert Counter((r["doc_id"], *library.encode(r["text"])) for r in before) == Counter((r["doc_id"], *r["ids"]) for r in after)
    assert all(r["n_tokens"] == len(r["ids"]) for r in after)


def test_empty_table(spark, tmp_path):
    docs = table(spark, [])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_that_no_id_names(spark):
    """Groups whose ids are all null keep one row; words-free rows all stay."""
    some = [(None, t, *rest) for _, t, *rest in rows()[:2]] * 2 + [(None, " ", None, None)] * 2
    out = corpus_pipeline.near_duplicates(spark, table(spark, some), "").collect()
    assert Counter(r["text"] for r in out) == {some[0][1]: 1, some[1][1]: 1, " ": 2}
