"""Quality classifier by co-training of a text view and a metadata view.

The text view sees the content only: shares of character classes, repetition,
line and word lengths, and hashed word frequencies. The metadata view sees
source, language label and length as stored, never the text. Each view is a
regularised logistic regression.

Both start from the labelled sample. In every round each view scores all
unlabelled documents; those that it is sure of after calibration (probability
``sure`` or more of either class) become pseudo-labels of the other view, which
is then fitted again by Newton's method, its gradient and Hessian over the
pseudo-labels added up by Spark. Finally both
views are calibrated (logistic calibration on the held-out part of the labelled
sample) and combined: as views are taken to be independent given the class,
their log odds add up, less those of the prior.

Labels come from a bounded sample, first by hash of the id: at most ``sample``
labelled documents per class, one row (the least by text hash) of each. The
unlabelled documents all take part, row by row; their features are written
once. Which of them are pseudo-labels follows from the views of the rounds so
far and is worked out again in every pass. Scoring covers every
document. Null texts have zero text features, null metadata a bucket of its
own. If a class has no labels, every score is the labelled share of class one
(0.5 without labels) and every document is kept. Rows are independent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, blocks, first_by_hash, mix, stored, trim
from strata.llm.textstats import TextStats

WORD_BUCKETS = 128
SOURCE_BUCKETS, LANG_BUCKETS, LENGTH_BUCKETS = 64, 16, 24


def text_view(texts: list[str | None]) -> np.ndarray:
    stats = TextStats(texts)
    buf, w = stats.w.buf, stats.w
    per = lambda mask: np.diff(np.r_[0, np.cumsum(mask, dtype=np.int64)][w.offset])
    size = np.maximum(per(buf > 32), 1)
    words = np.maximum(stats.n_words, 1)
    lines = np.maximum(np.diff(stats.lines_first), 1)
    dense = [
        stats.n_words > 0,
        np.minimum(stats.n_symbols / size * 20, 2),
        np.minimum(per(buf == 33) / size * 20, 2),
        np.minimum(per(buf == 124) / words * 4, 2),
        per((buf >= 65) & (buf <= 90)) / size * 2,
        per((buf >= 48) & (buf <= 57)) / size * 5,
        np.minimum(per(np.isin(buf, np.frombuffer(b".,;:?", dtype=np.uint8))) / words, 1),
        stats.n_repeat_words / words,
        stats.n_dup_lines / lines,
        np.minimum(size / words, 20) / 10,
        np.minimum(np.log1p(words / lines), 8) / 4,
        np.minimum(np.log1p(words), 12) / 6,
    ]
    low = Words(texts)
    bucket = (mix(low.hashes()) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    hashed = np.bincount(low.doc * WORD_BUCKETS + bucket, minlength=len(texts) * WORD_BUCKETS).reshape(len(texts), -1)
    return np.column_stack([*dense, np.sqrt(hashed / words[:, None])])


def metadata_view(pdf: pd.DataFrame) -> np.ndarray:
    """One-hot buckets of source, lang and n_chars; the first bucket of each is null."""
    out = np.zeros((len(pdf), SOURCE_BUCKETS + LANG_BUCKETS + LENGTH_BUCKETS))
    rows = np.arange(len(pdf))

    def bucket(values: pd.Series, n: int) -> np.ndarray:
        codes, names = pd.factorize(values, use_na_sentinel=True)
        hashed = np.array([zlib.crc32(str(x).encode()) % (n - 1) + 1 for x in names] + [0])
        return hashed[codes]

    out[rows, bucket(pdf["source"], SOURCE_BUCKETS)] = 1
    out[rows, SOURCE_BUCKETS + bucket(pdf["lang"], LANG_BUCKETS)] = 1
    chars = pd.to_numeric(pdf["n_chars"]).to_numpy(dtype=np.float64, na_value=np.nan)
    step = np.where(np.isnan(chars), 0, 1 + np.clip(np.log2(np.maximum(np.nan_to_num(chars), 1)), 0, LENGTH_BUCKETS - 2))
    out[rows, SOURCE_BUCKETS + LANG_BUCKETS + step.astype(np.int64)] = 1
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights (bias last) of a regularised logistic regression by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], decay)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        grad = x.T @ (y - p) - penalty * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        w = w + np.linalg.solve(hess, grad)
    return w


def _margin(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class View:
    weights: np.ndarray
    slope: float
    shift: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log odds of class one."""
        return self.slope * _margin(self.weights, x) + self.shift


def _fit_view(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    w = logistic(x, y)
    a, b = logistic(_margin(w, held_x)[:, None], held_y, decay=1e-2)
    return View(w, max(float(a), 0.0), float(b))


@dataclass
class CoModel:
    views: tuple[View, View] | None
    prior: float

    def scores(self, text_x: np.ndarray, meta_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, metadata, combined) probabilities of class one."""
        if self.views is None:
            flat = np.full(len(text_x), self.prior)
            return flat, flat, flat
        a, b = (v.log_odds(x) for v, x in zip(self.views, (text_x, meta_x), strict=True))
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - np.log(self.prior / (1 - self.prior)))


def cotrain(
    labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray],
    rounds: int = 4, exchange: int = 200, sure: float = 0.95,
) -> CoModel:
    """Both views' classifiers from labelled rows (every fifth held out for calibration) and a pool."""
    held = np.arange(len(y)) % 5 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return CoModel(None, float(y.mean()) if len(y) else 0.5)
    own = [[x[~held]] for x in labelled]
    targets = [[y[~held]], [y[~held]]]
    open_ = np.ones(len(pool[0]), dtype=bool)
    for step in range(rounds + 1):
        views = [
            _fit_view(np.concatenate(own[k]), np.concatenate(targets[k]), labelled[k][held], y[held]) for k in (0, 1)
        ]
        if step == rounds:
            break
        gone = np.zeros(len(open_), dtype=bool)
        for k in (0, 1):
            p = _sigmoid(views[k].log_odds(pool[k]))
            for label, confidence in ((1.0, p), (0.0, 1 - p)):
                able = np.flatnonzero(open_ & (confidence >= sure))
                best = able[np.argsort(-confidence[able], kind="stable")[:exchange]]
                own[1 - k].append(pool[1 - k][best])
                targets[1 - k].append(np.full(len(best), label))
                gone[best] = True
        open_ &= ~gone
    return CoModel((views[0], views[1]), float(np.clip(y.mean(), 1e-3, 1 - 1e-3)))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in blocks(batches):
        yield pd.DataFrame(
            {
                "doc_id": pdf["doc_id"],
                "text_x": [x.tobytes() for x in text_view(pdf["text"].tolist()).astype(np.float32)],
                "meta_x": [np.packbits(x).tobytes() for x in metadata_view(pdf).astype(bool)],
            }
        )


def _unpack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Both views' features of stored rows."""
    n = len(pdf)
    text = np.frombuffer(b"".join(pdf["text_x"]), dtype=np.float32).reshape(n, -1).astype(np.float64)
    bits = np.frombuffer(b"".join(pdf["meta_x"]), dtype=np.uint8).reshape(n, -1)
    return text, np.unpackbits(bits, axis=1, count=SOURCE_BUCKETS + LANG_BUCKETS + LENGTH_BUCKETS).astype(np.float64)


def _pseudo_labels(x: tuple[np.ndarray, np.ndarray], past: list[tuple[View, View]], sure: float) -> list[np.ndarray]:
    """The label that each view has been taught for every row by the rounds so far; nan where none."""
    taught = [np.full(len(x[0]), np.nan), np.full(len(x[0]), np.nan)]
    open_ = np.ones(len(x[0]), dtype=bool)
    for views in past:
        gone = np.zeros(len(open_), dtype=bool)
        for k in (0, 1):
            p = _sigmoid(views[k].log_odds(x[k]))
            for label, confidence in ((1.0, p), (0.0, 1 - p)):
                able = open_ & (confidence >= sure)
                taught[1 - k][able] = label
                gone |= able
        open_ &= ~gone
    return taught


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hessian of the log likelihood (negative), and the gradient as one more row."""
    x = np.column_stack([x, np.ones(len(x))])
    p = _sigmoid(x @ w)
    return np.vstack([(x * (p * (1 - p) + 1e-9)[:, None]).T @ x, x.T @ (y - p)])


def _pool_sums(pool: DataFrame, past: list[tuple[View, View]], weights: list[np.ndarray], sure: float) -> list[np.ndarray]:
    """The sums of both views over all pseudo-labels; rows of the sums are added up apart, so no task holds many."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros((len(w) + 1, len(w))) for w in weights]
        for pdf in batches:
            for at in range(0, len(pdf), 2048):
                x = _unpack(pdf.iloc[at : at + 2048])
                for k, y in enumerate(_pseudo_labels(x, past, sure)):
                    own = ~np.isnan(y)
                    if own.any():
                        total[k] += _sums(x[k][own], y[own], weights[k])
        for k in (0, 1):
            yield pd.DataFrame({"view": np.int32(k), "i": np.arange(len(total[k]), dtype=np.int32), "sums": [r.tobytes() for r in total[k]]})
        trim()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(r) for r in pdf["sums"]], axis=0)
        return pd.DataFrame({"view": [pdf["view"].iloc[0]], "i": [pdf["i"].iloc[0]], "sums": [total.tobytes()]})

    rows = pool.select("text_x", "meta_x").mapInPandas(run, "view int, i int, sums binary")
    got = rows.groupBy("view", "i").applyInPandas(add, "view int, i int, sums binary").collect()  # one row per feature
    out = [np.zeros((len(w) + 1, len(w))) for w in weights]
    for r in got:
        out[r["view"]][r["i"]] = np.frombuffer(r["sums"])
    return out


def cotrain_all(
    labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: DataFrame,
    rounds: int = 4, sure: float = 0.95, decay: float = 1.0, steps: int = 12,
) -> CoModel:
    """As ``cotrain``, with all rows of the table ``pool`` (text_x, meta_x as stored) and all that a view is sure of."""
    held = np.arange(len(y)) % 5 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return CoModel(None, float(y.mean()) if len(y) else 0.5)

    def calibrated(weights: list[np.ndarray]) -> tuple[View, View]:
        out = []
        for w, x in zip(weights, labelled, strict=True):
            a, b = logistic(_margin(w, x[held])[:, None], y[held], decay=1e-2)
            out.append(View(w, max(float(a), 0.0), float(b)))
        return out[0], out[1]

    weights = [logistic(x[~held], y[~held], decay, steps) for x in labelled]
    past: list[tuple[View, View]] = []
    for _ in range(rounds):
        past.append(calibrated(weights))
        for _ in range(steps):
            sums, moved = _pool_sums(pool, past, weights, sure), 0.0
            for k, x in enumerate(labelled):
                total = sums[k] + _sums(x[~held], y[~held], weights[k])
                penalty = np.full(len(weights[k]), decay)
                penalty[-1] = 1e-6
                step = np.linalg.solve(total[:-1] + np.diag(penalty), total[-1] - penalty * weights[k])
                weights[k] = weights[k] + step
                moved = max(moved, float(np.abs(step).max()))
            if moved < 1e-3:
                break
    return CoModel(calibrated(weights), float(np.clip(y.mean(), 1e-3, 1 - 1e-3)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, **options) -> CoModel:
    """``docs`` (doc_id, text, source, lang, n_chars), ``labels`` (doc_id, quality)."""
    marked = labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    columns = ["text", "source", "lang", "n_chars"]
    docs = docs.where("text IS NOT NULL").select("doc_id", *columns)
    ids = docs.select("doc_id").distinct().join(marked, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    picked = first_by_hash(ids, "quality", ["h", "doc_id"], sample).select("doc_id", "quality", "h")
    rows = docs.join(F.broadcast(picked), "doc_id")  # 2 * sample ids
    # One row per id, before anything reaches the driver: the least by text hash.
    least = F.min_by(F.struct(*columns), F.struct(F.xxhash64("text"), *columns[1:])).alias("d")
    rows = rows.groupBy("doc_id", "quality", "h").agg(least).select("doc_id", "d.*")
    types = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_x binary, meta_x binary"
    known = rows.mapInPandas(_features, types).join(F.broadcast(picked), "doc_id").toPandas()
    known = known.sort_values("h", kind="stable")
    if not len(known):
        return CoModel(None, 0.5)
    features = stored(docs.mapInPandas(_features, types).join(marked.select("doc_id"), "doc_id", "left_anti"), "pool")
    return cotrain_all(_unpack(known), known["quality"].to_numpy(dtype=np.float64), features, **options)


def quality(model: CoModel, docs: DataFrame, threshold: float = 0.5) -> Column:
    """Struct (text_score, meta_score, score, kept) of a row of ``docs`` (text, source, lang, n_chars)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    @F.pandas_udf("text_score double, meta_score double, score double, kept boolean")
    def udf(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for text, source, lang, chars in batches:
            frame = pd.DataFrame({"text": text, "source": source, "lang": lang, "n_chars": chars})
            out = [pd.DataFrame({"text_score": [], "meta_score": [], "score": [], "kept": []}, dtype=float).astype({"kept": bool})]
            for block in blocks(iter([frame])):
                a, b, both = shared.value.scores(text_view(block["text"].tolist()), metadata_view(block))
                kept = (both >= threshold) | (shared.value.views is None)
                out.append(pd.DataFrame({"text_score": a, "meta_score": b, "score": both, "kept": kept}))
            yield pd.concat(out[1:] or out, ignore_index=True)

    return udf.asNondeterministic()("text", "source", "lang", "n_chars")
