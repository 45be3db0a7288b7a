from __future__ import annotations

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import sentencepieces as sp

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=sp.DEFAULT_MODEL)
PIECES = sp.Pieces.load(sp.DEFAULT_MODEL)
_PARTS = st.lists(st.sampled_from(["the", " ", "  ", "ing", "é", "漢", "字", "😀", "\n", "\t", "0", "==", "un", "happi", "ness", "\u0000", "ﬁ", "A"]), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(_PARTS.map("".join), st.text(max_size=30)), max_size=4))
def test_equals_the_library_and_round_trips(texts):
    texts = [t.replace(sp.SPACE, "_") for t in texts]
    got = sp.Encoder(PIECES).encode(texts)
    assert [g.tolist() for g in got] == [LIBRARY.encode(t) for t in texts]
    assert [sp.decode_ids(PIECES, g) for g in got] == texts


def test_state_kept_between_blocks_changes_nothing(monkeypatch):
    texts = [f"word{k} shared words here {k % 7}" for k in range(60)]
    fresh = [sp.Encoder(PIECES).encode([t])[0].tolist() for t in texts]
    monkeypatch.setattr(sp, "KEPT", 10)  # starts anew again and again
    monkeypatch.setattr(sp, "MATCHED", 20)  # many small suffix arrays
    encoder = sp.Encoder(PIECES)
    assert [encoder.encode([t])[0].tolist() for t in texts] == fresh


@pytest.mark.parametrize("depth", [1, 3, 16])
def test_suffix_array(depth):
    rng = np.random.default_rng(depth)
    s = rng.integers(1, 4, 200)
    order, _ = sp.suffix_array(s, depth)
    cut = [tuple(s[i : i + depth]) for i in order]
    assert cut == sorted(cut) and sorted(order) == list(range(200))


def _toy(scores: dict[str, float]) -> sp.Pieces:
    words = sorted(scores)
    return sp.Pieces("unigram", ["<unk>", *words], np.arange(1, len(words) + 1), np.array([scores[w] for w in words]), np.zeros(0, dtype=np.int64), 0)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abc x", max_size=25), st.integers(0, 10**6))
def test_best_path_against_dynamic_programming(text, seed):
    rng = np.random.default_rng(seed)
    words = {sp.SPACE, "a", "b"} | {"".join(rng.choice(list("abc"), size=int(rng.integers(1, 5)))) for _ in range(12)} | {sp.SPACE + "a", sp.SPACE + "ab"}
    pieces = _toy({w: -float(rng.uniform(1, 9)) for w in words})
    score = dict(zip([pieces.surface[i] for i in pieces.text_ids], pieces.scores, strict=True))
    least = pieces.scores.min() - 10.0
    whole = (sp.SPACE + text.replace(" ", sp.SPACE)) if text else ""
    best = [0.0] + [-np.inf] * len(whole)
    for end in range(1, len(whole) + 1):
        for start in range(max(0, end - pieces.longest), end):
            w = whole[start:end]
            s = score.get(w, least if end - start == 1 else -np.inf)
            best[end] = max(best[end], best[start] + s)
    ids = sp.Encoder(pieces).encode([text])[0]
    total = sum(score[pieces.surface[i]] if i else least for i in ids)
    assert abs(total - best[-1]) < 1e-9


def test_columns(spark):
    df = spark.createDataFrame([("a b",), (None,), ("",), (" lead and trail ",)], "text string")
    out = df.select("text", sp.encode(F.col("text")).alias("r")).select("text", "r.*", sp.decode(F.col("r.ids")).alias("back")).collect()
    for r in out:
        assert r["back"] == r["text"]
        assert r["ids"] == (None if r["text"] is None else LIBRARY.encode(r["text"]))
        assert r["exact"] is (None if r["text"] is None else True)


def test_pieces_that_span_words_are_refused():
    with pytest.raises(ValueError, match="span words"):
        _toy({f"a{sp.SPACE}b": -1.0})


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_long_chunks_are_relaxed_alike(monkeypatch, rounds):
    """Edge by edge from a heap or all chunks together: the same merges."""
    monkeypatch.setattr(sp, "ROUNDS", rounds)
    rng = np.random.default_rng(rounds)
    texts = ["".join(rng.choice(list("etaoinshr  é漢"), size=int(rng.integers(0, 400)))) for _ in range(60)] + ["aaaaaaaaaaaaa" * 9, "thethethe" * 30]
    assert [g.tolist() for g in sp.Encoder(PIECES).encode(texts)] == [LIBRARY.encode(t) for t in texts]


def test_a_very_long_run_without_spaces():
    """Time near-linear in the run's length: a run of 300,000 letters, ids equal to the library's."""
    import time

    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789+/"), size=300_000))
    began = time.perf_counter()
    ids = sp.Encoder(PIECES).encode([text])[0]
    assert time.perf_counter() - began < 60
    assert ids.tolist() == LIBRARY.encode(text)
