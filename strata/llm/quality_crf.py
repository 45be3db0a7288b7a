"""Quality rules: a linear-chain CRF marks lines as content or boilerplate.

Each \\n-split line with a word has a feature vector (length, character
classes, repetition inside the line and of earlier lines). The CRF scores a
label sequence by emission weights per feature and transition weights between
neighbouring lines. It is fitted by maximum likelihood (forward-backward) on a
bounded sample of labelled documents: lines of good documents are content,
lines of bad ones boilerplate; two documents make one training sequence, so
that changes inside a text are learned too. Viterbi decoding then labels the lines of every
document, and the share of its characters in content lines decides.

Base rules (they fail a document whatever its lines are): fewer than 50 words,
or more than half of the words inside 3-word windows that repeat in the text.

Null and empty texts have no words and fail. Without labels of both classes
every line is content and the base rules alone decide. Rows are independent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, first_by_hash, mix
from strata.llm.textstats import TextStats

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT, BOILERPLATE = 0, 1


def line_features(stats: TextStats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines with a word, their features, their characters)."""
    buf = stats.w.buf
    some = np.flatnonzero(stats.line_words > 0)
    size = np.maximum(stats.per_line((buf > 32)), 1)[some]
    share = lambda mask: stats.per_line(mask)[some] / size
    words = stats.line_words[some]
    upper = (buf >= 65) & (buf <= 90)
    ends = np.isin(buf, np.frombuffer(b".!?", dtype=np.uint8))
    columns = [
        np.ones(len(some)),
        words <= 3,
        words <= 10,
        np.log1p(words) / 5,
        np.minimum(size / words, 20) / 10,
        np.minimum(share(stats.symbol) * 5, 1),
        share(stats.symbol) > 0.02,
        np.minimum(share(upper) * 2, 1),
        share(upper) > 0.3,
        share((buf >= 48) & (buf <= 57)),
        np.minimum(share(buf == 33) * 5, 1),
        np.minimum(share(buf == 124) * 5, 1),
        share(ends) > 0,
        1 - stats.line_distinct[some] / words,
        (stats.line_distinct[some] * 2 < words) & (words > 3),
        stats.line_repeats[some],
    ]
    return some, np.column_stack([np.asarray(c, dtype=np.float64) for c in columns]), size


@dataclass
class LineCrf:
    emit: np.ndarray  # [features, labels]
    move: np.ndarray  # [from, to]
    begin: np.ndarray  # [labels]


def _by_step(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequences by falling length; how many of them reach each step."""
    order = np.argsort(-lengths, kind="stable")
    first = np.r_[0, np.cumsum(lengths)][:-1]
    longest = int(lengths.max()) if len(lengths) else 0
    alive = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    return order, first, alive.tolist()


def viterbi(crf: LineCrf, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best label of each line; ``features`` holds the sequences of ``lengths`` one after another."""
    scores = features @ crf.emit
    order, first, alive = _by_step(lengths)
    labels = np.zeros(len(features), dtype=np.int64)
    back = np.zeros((len(features), 2), dtype=np.int8)
    best = None
    for t, n in enumerate(alive):
        at = first[order[:n]] + t
        if t == 0:
            best = crf.begin + scores[at]
        else:
            through = best[:n, :, None] + crf.move
            back[at] = through.argmax(axis=1)
            best = np.concatenate([through.max(axis=1) + scores[at], best[n:]])
    if best is not None:
        full = order[: len(best)]
        last = best.argmax(axis=1)
        for t in range(len(alive) - 1, -1, -1):
            n = alive[t]
            at = first[full[:n]] + t
            labels[at] = last[:n]
            last[:n] = back[at, last[:n]]
    return labels


def train(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, steps: int = 200, rate: float = 0.1, decay: float = 1e-3):
    """Maximum-likelihood weights by gradient steps (Adam); all sequences in every step."""
    n_features = features.shape[1]
    theta = np.zeros(n_features * 2 + 6)
    order, first, alive = _by_step(lengths)
    hot = np.eye(2)[labels]
    later = np.ones(len(features), dtype=bool)
    later[first] = False
    idx = np.flatnonzero(later)
    seen_move = hot[idx - 1].T @ hot[idx]
    seen = np.r_[(features.T @ hot).ravel(), seen_move.ravel(), hot[first].sum(axis=0)]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        emit, move, begin = theta[:-6].reshape(n_features, 2), theta[-6:-2].reshape(2, 2), theta[-2:]
        scores = features @ emit
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        for t, n in enumerate(alive):
            at = first[order[:n]] + t
            forward[at] = scores[at] + (begin if t == 0 else np.logaddexp.reduce(forward[at - 1][:, :, None] + move, axis=1))
        for t in range(len(alive) - 2, -1, -1):
            n = alive[t + 1]
            at = first[order[:n]] + t
            backward[at] = np.logaddexp.reduce(move + (scores[at + 1] + backward[at + 1])[:, None, :], axis=2)
        joint = forward + backward
        log_z = np.logaddexp.reduce(joint, axis=1)
        node = np.exp(joint - log_z[:, None])
        pair = forward[idx - 1][:, :, None] + move + (scores[idx] + backward[idx])[:, None, :]
        pair = np.exp(pair - log_z[idx][:, None, None]).sum(axis=0)
        expected = np.r_[(features.T @ node).ravel(), pair.ravel(), node[first].sum(axis=0)]
        grad = (seen - expected) / len(lengths) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LineCrf(theta[:-6].reshape(n_features, 2), theta[-6:-2].reshape(2, 2), theta[-2:])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 2000, max_bytes: int = 50_000) -> LineCrf | None:
    """Fit on at most ``sample`` documents of each quality label (first by hash of the id).

    ``docs`` (doc_id, text), ``labels`` (doc_id, quality). Texts over
    ``max_bytes`` are left out of the sample only, so it is bounded by
    2 * sample * max_bytes. None if one class is missing.
    """
    marked = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    short = docs.where(f"octet_length(text) <= {int(max_bytes)}")
    ranked = short.select("doc_id").distinct().join(marked, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    picked = first_by_hash(ranked, "quality", ["h", "doc_id"], sample).select("doc_id", "quality")
    # At most 2 * sample ids: the texts are picked where they are read, not shuffled.
    rows = short.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Of repeated rows of an id, the least by text hash counts, so at most 2 * sample rows are collected.
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # One row per document: lines' features, flattened.
    names = rows.select("doc_id", "quality", "text").mapInPandas(_training_rows, "h long, quality int, lines int, features array<double>")
    got = sorted((r for r in names.collect() if r["lines"]), key=lambda r: (r["h"], r["lines"], r["features"]))
    if {r["quality"] for r in got} != {0, 1}:
        return None
    lengths = np.array([r["lines"] for r in got])
    features = np.concatenate([np.array(r["features"]).reshape(r["lines"], -1) for r in got])
    quality = np.repeat([r["quality"] for r in got], lengths)
    pairs = np.add.reduceat(lengths, np.arange(0, len(lengths), 2))
    return train(features, np.where(quality == 1, CONTENT, BOILERPLATE), pairs)


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in blocks(batches):
        stats = TextStats(pdf["text"].tolist())
        some, features, _ = line_features(stats)
        cut = np.searchsorted(stats.line_doc[some], np.arange(len(pdf) + 1))
        yield pd.DataFrame(
            {
                "h": mix(pdf["doc_id"].to_numpy(dtype=np.int64)).view(np.int64),
                "quality": pdf["quality"].astype(np.int32),
                "lines": np.diff(cut).astype(np.int32),
                "features": [features[a:b].ravel() for a, b in zip(cut, cut[1:], strict=False)],
            }
        )


def _assess(crf: LineCrf | None, texts: list[str | None], min_content: float) -> pd.DataFrame:
    stats = TextStats(texts)
    some, features, size = line_features(stats)
    docs = stats.line_doc[some]
    lengths = np.bincount(docs, minlength=len(texts))
    if crf is None:
        label = np.zeros(len(some), dtype=np.int64)
    else:
        present = np.flatnonzero(lengths)
        label = viterbi(crf, features, lengths[present])
    whole = np.bincount(docs, weights=size, minlength=len(texts))
    content = np.bincount(docs, weights=size * (label == CONTENT), minlength=len(texts))
    share = np.divide(content, whole, out=np.zeros(len(texts)), where=whole > 0)
    failed = (stats.n_words < MIN_WORDS) | (100 * stats.n_repeat_words > MAX_REPEAT_PERCENT * stats.n_words)
    return pd.DataFrame(
        {
            "n_words": stats.n_words,
            "word_chars": stats.word_chars,
            "n_symbols": stats.n_symbols,
            "n_dup_lines": stats.n_dup_lines,
            "n_repeat_words": stats.n_repeat_words,
            "base_failed": failed,
            "kept": ~failed & (share >= min_content),
            "content_share": share,
            "n_lines": lengths,
            "n_boilerplate": np.bincount(docs, weights=label == BOILERPLATE, minlength=len(texts)).astype(np.int64),
        }
    )


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, content_share double, n_lines long, n_boilerplate long"
)


def assess(crf: LineCrf | None, text: Column, spark, min_content: float = 0.5) -> Column:
    """Struct of counts, base verdict, content share and final verdict of the text."""
    shared = spark.sparkContext.broadcast(crf)  # a few dozen weights

    @F.pandas_udf(RESULT)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [_assess(shared.value, b["text"].tolist(), min_content) for b in blocks(iter([texts.to_frame("text")]))]
            yield pd.concat(parts, ignore_index=True) if parts else _assess(shared.value, [], min_content)

    return udf.asNondeterministic()(text)
