"""Language identification by language-bitmask n-gram filters.

N-grams are the letters of the lower-cased text and the trigrams around them
(three code points, every run of non-letters read as one space, the middle one
a letter). Training weighs each document the same and keeps every n-gram of
every language: nothing rare, shared or foreign-looking is left out.

The model is one Bloom filter in slices: position j holds a bitmask of all
languages, a byte for each. Bit 0 of a byte stands for "the language contains
the n-gram", bits 1 to 7 for "with at least this share of its text" (BANDS).
The AND of an n-gram's positions is the mask of all languages that contain it.
A text's n-grams give a popcount per language and band; with the share f of the
bits that are set, an n-gram that does not belong passes by chance with
f**hashes, so a popcount c of n n-grams is corrected to
(c - n f**h) / (1 - f**h). The largest sum over the bands wins, ties going to
the language with more training documents, then by code point.

The score is that sum per n-gram against what the language's own documents
usually reach, at most 1. "Usually" leaves the document itself out: n-grams
that occur in one training document only count as absent. So a language of many
letters, whose trigrams are mostly new in every text, is not held to the
coverage of an alphabetic one.

The filter's size follows the number of n-grams up to ``max_bytes``; beyond,
more foreign n-grams pass and the correction takes more off. The bits are set
in Spark (a bitwise or per position), and only the filter comes to the driver.

Null texts and texts without a letter get ``und`` and score 0. So does every
text if no language was learned. Repeated rows count as often as they occur.
A very long text is one block of its worker; its time and memory are linear in
its length. An empty table learns no language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import blocks, mix, stored

UNKNOWN = "und"
#: Weight that each training document spreads over its trigrams (whole numbers keep sums exact).
DOC_MASS = 1 << 30
#: Dense trigram tables are used up to this many cells, sorted codes beyond.
DENSE_CELLS = 1 << 22
#: Least share of a language's text in each band; band 0 holds all n-grams that the language contains.
BANDS = (0.0, *(4.0**-k for k in range(8, 1, -1)))
#: Positions that are packed in one row on their way to the driver.
CHUNK = 1 << 12
#: A band that lets nearly everything pass tells nothing; its correction divides by at least 1 - this.
MOST_CHANCE = 0.99


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


class Ngrams:
    """N-grams of a block of texts.

    Per letter: ``letter`` (index into ``letters``) and ``gram``, its trigram
    (index into ``trigrams``). ``n`` letters per text, the first at ``first``.
    """

    def __init__(self, texts: list[str | None]):
        lowered = ["" if t is None else t.lower() for t in texts]
        joined = " " + " ".join(lowered) + " "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        points = np.where(letter, points, np.uint32(32))
        middle = np.flatnonzero(letter)
        length = np.fromiter((len(t) + 1 for t in lowered), dtype=np.int64, count=len(lowered))
        self.first = np.searchsorted(middle, 1 + np.r_[0, np.cumsum(length)])
        self.n = np.diff(self.first)
        seen = np.zeros(0x110000, dtype=bool)
        seen[points] = True
        alphabet = np.flatnonzero(seen)
        rank = np.zeros(0x110000, dtype=np.int64)
        rank[alphabet] = np.arange(len(alphabet))
        r, size = rank[points], len(alphabet)
        cell = (r[middle - 1] * size + r[middle]) * size + r[middle + 1]
        if size**3 <= DENSE_CELLS:
            used = np.flatnonzero(np.bincount(cell, minlength=size**3))
            index = np.zeros(size**3, dtype=np.int32)
            index[used] = np.arange(len(used))
            self.gram = index[cell]
        else:
            used, self.gram = np.unique(cell, return_inverse=True)
        a, rest = np.divmod(used, size * size)
        b, c = np.divmod(rest, size)
        self.trigrams = (alphabet[a].astype(np.int64) << 42) | (alphabet[b].astype(np.int64) << 21) | alphabet[c]
        self.letter, self.letters = r[middle], alphabet.astype(np.int64) << 21  # no neighbours: not a trigram's code

    def kinds(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index per letter, codes) of the letters and of the trigrams."""
        yield self.letter, self.letters
        yield self.gram, self.trigrams


def _masses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, gram, mass, many) per block; many: in more than one document. gram -1 carries the number of documents."""
    for pdf in blocks(batches):
        grams = Ngrams(pdf["text"].tolist())
        weight = np.maximum(DOC_MASS // np.maximum(grams.n, 1), 1)
        doc = np.repeat(np.arange(len(pdf)), grams.n)
        names, which = np.unique(pdf["lang"].to_numpy(dtype=object).astype(str), return_inverse=True)
        for k, name in enumerate(names):
            own = which == k
            at = np.flatnonzero(own[doc])
            parts = [(np.array([-1]), np.array([(own & (grams.n > 0)).sum()]), np.array([False]))]
            for index, codes in grams.kinds():
                seen, of = index[at], doc[at]
                mass = np.bincount(seen, weights=weight[of], minlength=len(codes)).astype(np.int64)
                least, most = np.zeros((2, len(codes)), dtype=np.int64)
                most[seen] = of  # documents are in order: the last one stays
                least[seen[::-1]] = of[::-1]
                some = np.flatnonzero(mass)
                parts.append((codes[some], mass[some], least[some] != most[some]))
            gram, mass, many = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pd.DataFrame({"lang": name, "gram": gram.astype(np.int64), "mass": mass.astype(np.int64), "many": many})


@dataclass
class LanguageModel:
    langs: list[str]
    docs: list[int]  # training documents with a letter
    slices: np.ndarray  # [positions, languages]: a byte of bands
    hashes: int
    chance: np.ndarray  # [languages, bands]: chance of an n-gram that does not belong to pass
    usual: np.ndarray  # mean popcount that an n-gram of the language's own documents reaches

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """[n-grams, languages]: the bands in which each language may contain each n-gram."""
        out = None
        for pos in _positions(codes, self.hashes, len(self.slices)):
            out = self.slices[pos] if out is None else out & self.slices[pos]
        return out

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Per language: corrected popcount of every byte, and what each n-gram takes off it."""
        chance = np.minimum(self.chance, MOST_CHANCE)
        byte = (np.arange(256)[:, None] >> np.arange(len(BANDS))) & 1
        return (1 / (1 - chance)) @ byte.T, (chance / (1 - chance)).sum(axis=1)


def _positions(codes: np.ndarray, hashes: int, m: int) -> Iterator[np.ndarray]:
    one = mix(codes.astype(np.uint64) + np.uint64(1))
    two = mix(one) | np.uint64(1)
    for k in range(hashes):
        yield ((one + np.uint64(k) * two) % np.uint64(m)).astype(np.int64)


def fit(docs: DataFrame, hashes: int = 4, bits_per_gram: int = 12, max_bytes: int = 32 << 20) -> LanguageModel:
    """Learn from all rows of ``docs`` (text, lang) with a non-null lang.

    The languages' names and the filter, of at most about ``max_bytes``, come
    to the driver; the number of languages is taken to be moderate.
    """
    spark = docs.sparkSession
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    sums = rows.mapInPandas(_masses, "lang string, gram long, mass long, many boolean").groupBy("lang", "gram")
    many = F.bool_or("many") | (F.count(F.lit(1)) > 1)
    sums = stored(sums.agg(F.sum("mass").alias("mass"), many.alias("many")), "language-ngrams")
    # One row per language.
    found = sorted((r["lang"], r["mass"]) for r in sums.where("gram = -1 AND mass > 0").collect())
    langs = [name for name, _ in found]
    if not langs:
        none = np.zeros((0, len(BANDS)))
        return LanguageModel([], [], np.zeros((1, 0), dtype=np.uint8), hashes, none, np.zeros(0))
    known = spark.createDataFrame([(k, *x) for k, x in enumerate(found)], "k int, lang string, docs long")
    share = F.col("mass") / F.col("docs") / DOC_MASS
    bands = sum((F.when(share >= t, 1 << b).otherwise(0) for b, t in enumerate(BANDS)), F.lit(0))
    own = sums.where("gram <> -1").join(F.broadcast(known), "lang").select("k", "gram", "mass", "many", bands.alias("bands"))
    reach = F.col("mass").cast("double") * F.bit_count("bands")
    per_lang = own.groupBy("k").agg(
        F.count(F.lit(1)).alias("grams"),
        (F.sum(F.when(F.col("many"), reach).otherwise(0.0)) / F.sum("mass")).alias("usual"),
        (F.sum(reach) / F.sum("mass")).alias("within"),
    )
    per_lang = sorted(per_lang.collect(), key=lambda r: r["k"])
    # The largest language decides the size; the filter is a power of two of positions.
    grams = max(r["grams"] for r in per_lang)
    wanted = max(10, (grams * bits_per_gram - 1).bit_length())
    bound = max(10, (max_bytes // len(langs)).bit_length() - 1)
    m = 1 << min(wanted, bound)
    hashes = max(1, min(hashes, round(0.7 * m / grams)))
    n_langs, chunk = len(langs), min(m, CHUNK)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for pos in _positions(pdf["gram"].to_numpy(), hashes, m):
                yield pd.DataFrame({"pos": pos, "k": pdf["k"], "bands": pdf["bands"]})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros((chunk, n_langs), dtype=np.uint8)
        part[pdf["pos"].to_numpy() % chunk, pdf["k"].to_numpy()] = pdf["bands"].to_numpy()
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "part": [part.tobytes()]})

    bits = own.select("k", "gram", "bands").mapInPandas(place, "pos long, k int, bands int")
    bits = bits.groupBy("pos", "k").agg(F.bit_or("bands").alias("bands"))
    packed = bits.withColumn("chunk", F.expr(f"pos div {chunk}")).groupBy("chunk").applyInPandas(pack, "chunk long, part binary")
    slices = np.zeros((m // chunk, chunk * n_langs), dtype=np.uint8)
    for r in packed.toLocalIterator():  # m * n_langs bytes in all
        slices[r["chunk"]] = np.frombuffer(r["part"], dtype=np.uint8)
    slices = slices.reshape(m, n_langs)
    full = np.array([[((slices[:, k] >> b) & 1).mean() for b in range(len(BANDS))] for k in range(n_langs)])
    # Documents that share no n-gram at all say nothing on the usual: then what they reach with themselves counts.
    usual = np.array([r["usual"] if r["usual"] > 0 else r["within"] for r in per_lang])
    return LanguageModel(langs, [d for _, d in found], slices, hashes, full**hashes, usual)


def _predict(model: LanguageModel, texts: list[str | None]) -> pd.DataFrame:
    grams = Ngrams(texts)
    corrected = np.zeros((len(texts), len(model.langs)))
    value, off = model.weights()
    for index, codes in grams.kinds():
        masks = model.masks(codes)
        for k in range(len(model.langs)):
            total = np.r_[0.0, np.cumsum(value[k][masks[:, k]][index])]
            corrected[:, k] += total[grams.first[1:]] - total[grams.first[:-1]] - grams.n * off[k]
    order = np.lexsort((np.arange(len(model.langs)), -np.array(model.docs)))
    if len(order):
        # Sums of one text in other blocks differ in their last digits: ties are decided on rounded ones.
        best = order[np.argmax(np.round(corrected[:, order], 6), axis=1)]
        top = corrected[np.arange(len(texts)), best] / model.usual[best]
    else:
        best, top = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
    known = (grams.n > 0) & (len(order) > 0)
    score = np.round(np.clip(top / np.maximum(2 * grams.n, 1), 0.0, 1.0), 9)
    return pd.DataFrame(
        {
            "lang_pred": [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)],
            "score": np.where(known, score, 0.0),
            "n_letters": grams.n.astype(np.int64),
        }
    )


def language(model: LanguageModel, text: Column, spark) -> Column:
    """Struct (lang_pred, score, n_letters) of the text."""
    shared = spark.sparkContext.broadcast(model)  # at most about max_bytes of fit()

    @F.pandas_udf("lang_pred string, score double, n_letters long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [_predict(shared.value, b["text"].tolist()) for b in blocks(iter([texts.to_frame("text")]))]
            yield pd.concat(parts, ignore_index=True) if parts else _predict(shared.value, [])

    return udf.asNondeterministic()(text)  # evaluated once, never copied into a pushed filter
