"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling, learned and applied on Spark.

Tokens are the words of a text with A-Z lowered, then one end. The context of
a token is the word before it, or the start. Three levels of restaurants serve
words: one per context; above them one per class of contexts (a hash of the
last three bytes of the context's word, or the start; CLASSES in all), which
smooths rare contexts; above these one root, whose base is uniform over the V
training words and one unknown. The customers of a context's dish are its
occurrences there; each of its tables is a customer of the class, each table of
a class one of the root.

Learning. Occurrences are counted per (word, context) in each task, then per
hash bucket of the words, so that no frequent word is shuffled one occurrence
at a time; a context's dishes are spread over all buckets. The counts are
written once, in a table bucketed by that number, and never shuffled again. A
sweep resamples the seating of all customers of every dish: the number of
tables of a dish is drawn at once from its law given its customers, the other
tables of its restaurant and the parent without the dish (``draw_tables``),
first in the contexts, then in the classes, then in the root; a bucket has
several slices of words, each drawn from its own random stream. Between sweeps
only numbers of tables travel: every bucket sends the sums of its contexts to
the contexts' parts, which add them up over all buckets and send the totals
back. Which contexts a bucket has is told to the parts once, before the first
sweep; later messages keep that order. The totals of the classes and the root
are refreshed, too. Within a sweep the dishes of a restaurant are drawn side by
side, given the totals of the sweep before. After ``burn_in`` sweeps,
``samples`` sweeps are kept; the predictive probability of a word is the mean
over the kept seatings.

Scoring. The most frequent (word, context) pairs, at most MAX_FREQUENT, are
sent to the tasks with their probabilities, and as many contexts with their
back-off weights; all other tokens of the texts meet their word's bucket, large
buckets split by salt. Tokens of a rare context whose pair was never seen go on
to the part of the context. Sums per text are exact sums over all its tokens.

Words are told apart by 59-bit hashes, pairs by 64-bit hashes. Null texts count
as empty: one token, the end. Rows equal in id and text are scored alike. With
no training text the model is uniform over one unknown word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, blocks, expand_copies, mix, pack, pack_ids, stored, stored_by, trim, unpack, unpack_ids

#: Classes of contexts; word identities leave their lowest bits for them.
CLASSES = 32
_CLASS_MASK = np.int64(CLASSES - 1)
MAX_FREQUENT = 100_000
#: Dishes (about) that are drawn at once from one random stream, a slice; slices of a bucket; tokens that one task takes for a bucket at once.
SLICE_DISHES = 100_000
BUCKET_SLICES = 10
BUCKET_TOKENS = 8_000_000
#: Tokens that a task counts at once, and pairs or tokens that it holds before it sends them on.
FLUSH = 1 << 20
HELD = 1 << 21
#: Counts below this are tallied one by one to find the most frequent.
TALLIED = 4096
STRENGTH = 1.0
_END = int(mix(np.array([0xE0D], dtype=np.uint64)).view(np.int64)[0]) & ~(CLASSES - 1)


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word and context per token, tokens per text): every text's words, then the end; a context's low bits are its class."""
    w = Words(texts)
    ids = w.hashes().view(np.int64) & ~_CLASS_MASK
    size = w.end - w.start
    tail = np.zeros(len(ids), dtype=np.uint64)
    for k in range(1, 4):
        byte = w.buf[np.maximum(w.end - k, 0)].astype(np.uint64)
        tail = (tail << np.uint64(8)) | np.where(size >= k, byte, 0)
    classes = (mix(tail) % np.uint64(CLASSES - 1)).astype(np.int64) + 1  # 0 is the start
    per_text = np.diff(w.first) + 1
    last = np.cumsum(per_text) - 1
    out = np.empty(len(ids) + len(per_text), dtype=np.int64)
    is_end = np.zeros(len(out), dtype=bool)
    is_end[last] = True
    out[is_end], out[~is_end] = _END, ids
    before = np.zeros(len(out), dtype=np.int64)
    before[~is_end] = ids | classes
    context = np.r_[np.int64(0), before[:-1]]
    context[np.r_[0, last[:-1] + 1]] = 0
    return out, context, per_text


def _pair(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Identity of (word, context)."""
    return mix(mix(contexts.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ words.view(np.uint64)).view(np.int64)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix((keys & ~_CLASS_MASK).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _dealt(words: np.ndarray, slices: int) -> np.ndarray:
    """The bucket of each word: several slices."""
    return _bucket(words, slices) % -(-slices // BUCKET_SLICES)


def _parts(at: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of the buckets that occur in ``at``."""
    order = np.argsort(at.astype(np.uint16) if buckets <= 1 << 16 else at, kind="stable")
    edges = np.searchsorted(at[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), order[edges[b] : edges[b + 1]]


def _by_word(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Order by word, then by context: one sort of the word's rank and the context's upper bits, where these tell contexts apart."""
    _, rank = np.unique(words, return_inverse=True)
    key = (rank.astype(np.uint64) << np.uint64(40)) | ((contexts.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(24))
    order = np.argsort(key)
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if len(words) >= 1 << 24 or (contexts[order[same]] != contexts[order[same + 1]]).any():
        return np.lexsort((contexts, words))
    return order


def _summed(words: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs added up, by word (equal neighbours take hardly any room once packed), then by context."""
    order = _by_word(words, contexts)
    words, contexts = words[order], contexts[order]
    first = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])]) if len(words) else np.zeros(0, dtype=np.int64)
    return words[first], contexts[first], np.add.reduceat(counts[order], first) if len(first) else counts


_COUNTS = "bucket int, words binary, contexts binary, counts binary"
_COUNTS_COLUMNS = ["bucket", "words", "contexts", "counts"]


def _packed(b: int, words: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> tuple:
    return b, pack_ids(words), pack_ids(contexts), pack(counts)


def _unpacked(words: bytes, contexts: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (own_words, word), (own_contexts, context) = unpack_ids(words), unpack_ids(contexts)
    return own_words[word], own_contexts[context], unpack(counts)


def _alike(words: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs added up in the order of their identities (two pairs of one identity may stay apart in several entries)."""
    pairs = _pair(words, contexts)
    order = np.argsort(pairs)
    pairs, words, contexts = pairs[order], words[order], contexts[order]
    first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]) | (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])])
    return words[first], contexts[first], np.add.reduceat(counts[order], first)


def _count(slices: int):
    buckets = -(-slices // BUCKET_SLICES)

    def rows(held: list) -> pd.DataFrame:
        words, contexts, counts = _alike(*(np.concatenate(x) for x in zip(*held, strict=True))) if len(held) > 1 else held[0]
        out = []
        for b, p in _parts(_dealt(words, slices), buckets):
            p = p[np.argsort(words[p])]
            out.append(_packed(b, words[p], contexts[p], counts[p]))
        return pd.DataFrame(out, columns=_COUNTS_COLUMNS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, new, n = [], [], 0

        def added() -> tuple[np.ndarray, ...]:
            words, contexts = (np.concatenate(x) for x in zip(*new, strict=True))
            return _alike(words, contexts, np.ones(len(words), dtype=np.int64))

        for pdf in blocks(batches):
            words, contexts, _ = tokens(pdf["text"].tolist())
            new.append((words, contexts))
            n += len(words)
            if n >= FLUSH:
                held.append(added())
                new, n = [], 0
                if sum(len(x[0]) for x in held) >= HELD:
                    yield rows(held)
                    held = []
        if new:
            held.append(added())
        if held:
            yield rows(held)

    return run


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per bucket; equal pairs are added up as they come, so a frequent pair stays one entry."""
    sums: dict[int, tuple] = {}
    new: dict[int, list] = {}

    def added(b: int) -> tuple:
        parts = ([sums[b]] if b in sums else []) + new.pop(b, [])
        return _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    for pdf in batches:
        for b, *arrays in zip(*(pdf[c] for c in _COUNTS_COLUMNS), strict=True):
            new.setdefault(b, []).append(_unpacked(*arrays))
            if sum(len(x[0]) for x in new[b]) > max(FLUSH, len(sums[b][0]) if b in sums else 0):
                sums[b] = added(b)
    for b in sorted({*sums, *new}):
        yield pd.DataFrame([_packed(b, *(added(b) if b in new else sums[b]))], columns=_COUNTS_COLUMNS)
    trim()


# ---- seating ----------------------------------------------------------------------------------------------------


class Seating:
    """Customer by customer, the reference of ``draw_tables``. Tables of many dishes: customers and tables per dish, and the size of every table in dish order."""

    def __init__(self, customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator):
        """Seat the customers in doubling blocks; ``weight`` is that of a new table."""
        n = len(customers)
        self.discount, self.rng = discount, rng
        self.c = np.minimum(customers, 1).astype(np.int64)
        self.t = self.c.copy()
        self.dish, self.size = np.flatnonzero(self.c), np.ones(int(self.c.sum()), dtype=np.int64)
        while (live := np.flatnonzero(self.c < customers)).size:
            block = np.minimum(customers[live] - self.c[live], np.maximum(self.c[live], 1))
            rest = self.c[live] - discount * self.t[live]
            opened = rng.binomial(block, weight[live] / (weight[live] + rest))
            joined = np.zeros(n)
            joined[live] = (block - opened) / rest
            more = np.floor((self.size - discount) * joined[self.dish]).astype(np.int64)
            given = np.bincount(self.dish, weights=more, minlength=n).astype(np.int64)
            self.size += more
            first = np.cumsum(self.t) - self.t
            self.size[first[live]] += block - opened - given[live]
            self.dish = np.r_[self.dish, np.repeat(live, opened)]
            self.size = np.r_[self.size, np.ones(int(opened.sum()), dtype=np.int64)]
            order = np.argsort(self.dish, kind="stable")
            self.dish, self.size = self.dish[order], self.size[order]
            self.c[live] += block
            self.t[live] += opened

    def remove(self, d: np.ndarray) -> np.ndarray:
        """Take a random customer from each of the (different) dishes d; True where a table closed."""
        upto = np.cumsum(self.size)
        first = (np.cumsum(self.t) - self.t)[d]
        pick = upto[first] - self.size[first] + (self.rng.random(len(d)) * self.c[d]).astype(np.int64)
        table = np.searchsorted(upto, pick, side="right")
        self.size[table] -= 1
        self.c[d] -= 1
        closed = self.size[table] == 0
        if closed.any():
            keep = np.ones(len(self.size), dtype=bool)
            keep[table[closed]] = False
            self.dish, self.size = self.dish[keep], self.size[keep]
            self.t[d[closed]] -= 1
        return closed

    def add(self, d: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Seat one customer at each of the (different) dishes d; True where a table opened."""
        rest = self.c[d] - self.discount * self.t[d]
        opened = (self.rng.random(len(d)) * (weight + rest) < weight) | (self.t[d] == 0)
        first = np.cumsum(self.t) - self.t
        old = d[~opened]
        if len(old):
            upto = np.cumsum(self.size - self.discount)
            lo, hi = first[old], first[old] + self.t[old] - 1
            before = upto[lo] - (self.size[lo] - self.discount)
            table = np.searchsorted(upto, before + self.rng.random(len(old)) * (upto[hi] - before), side="right")
            self.size[np.clip(table, lo, hi)] += 1
        new = d[opened]
        if len(new):
            at = first[new] + self.t[new]
            self.dish, self.size = np.insert(self.dish, at, new), np.insert(self.size, at, 1)
            self.t[new] += 1
        self.c[d] += 1
        return opened


#: Up to so many customers the law of a dish's tables is tabulated; above, it is integrated numerically.
EXACT = 1024


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series for x > 0, carried back from x + 8."""
    back = sum(np.log(x + k) for k in range(8))
    x = x + 8
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - back


@functools.lru_cache(maxsize=4)
def _log_ways(discount: float) -> np.ndarray:
    """Row c - 1, column t - 1: log of the generalised Stirling number of c customers at t tables."""
    out = np.full((EXACT, EXACT), -np.inf)
    out[0, 0] = 0.0
    for c in range(1, EXACT):
        t = np.arange(1, c + 1)
        out[c, :c] = out[c - 1, :c] + np.log(c - discount * t)
        out[c, 1 : c + 1] = np.logaddexp(out[c, 1 : c + 1], out[c - 1, :c])
    return out


def _log_ways_of(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """The same for any c > EXACT: the coefficient of z^c in ((1 - (1 - z)^d) / d)^t, times c! / t!.

    Cauchy's integral over z = exp(-w), w on a hyperbola through the saddle point that wraps the cut; where the
    tables are so many that the integrand turns within the nodes, the saddle-point approximation.
    """
    log_mean = lambda y: np.log(discount) + np.log(-np.expm1(-y)) + (1 - discount) * y - np.log(-np.expm1(-discount * y))
    want = np.log(c / t)
    lo, hi = np.full(c.shape, 1e-12), (want - np.log(discount) + 1) / (1 - discount) + 1  # 1 - z = exp(-y)
    for _ in range(45):
        y = (lo + hi) / 2
        below = log_mean(y) < want
        lo, hi = np.where(below, y, lo), np.where(below, hi, y)
    y = (lo + hi) / 2
    out = _log_gamma(c + 1.0) - _log_gamma(t + 1.0)
    many = t > c * (0.25 if discount < 0.6 else 0.9)
    if many.any():
        z, k, n = y[many], t[many], c[many]
        slope = 1 / np.expm1(z) + 1 - discount - discount / np.expm1(discount * z)
        spread = np.maximum(k * np.exp(log_mean(z)) * slope * np.expm1(z), 1e-300)
        out[many] += k * np.log(-np.expm1(-discount * z) / discount) - n * np.log(-np.expm1(-z)) - 0.5 * np.log(2 * np.pi * spread)
    if not many.all():
        k, n = t[~many][:, None], c[~many][:, None]
        angle, h = 0.8, 4.0 / 48
        least = np.maximum(-np.log(-np.expm1(-y[~many])), 6 * (1 - np.sin(angle)) / c[~many])[:, None]
        bend = least / (1 - np.sin(angle))
        u = 1j * (np.arange(48) + 0.5) * h - angle
        w = bend * (1 + np.sin(u))
        value = k * np.log((1 - (-np.expm1(-w)) ** discount) / discount) + n * w
        top = value.real.max(axis=1, keepdims=True)
        total = (np.exp(value - top) * bend * 1j * np.cos(u)).sum(axis=1).imag * h / np.pi
        out[~many] += top[:, 0] + np.log(np.abs(total))
    return out


def draw_tables(
    customers: np.ndarray, others: np.ndarray, p: np.ndarray, gain: np.ndarray, less: np.ndarray, discount: float, rng: np.random.Generator
) -> np.ndarray:
    """Tables of every dish, drawn from their law: the ways to seat the customers at t tables, times the product
    over k < t of (STRENGTH + discount * (others + k)) * (p + gain * (k - less)), the second term from k = 1 on.

    ``others`` are the other tables of the restaurant, ``p`` the parent's probability of the word without this dish,
    ``gain`` how much each of the dish's own customers there adds, ``less`` the discount if it opens a table there.
    """
    t = np.minimum(customers, 1).astype(np.int64)
    ways = _log_ways(discount)
    width = 2
    while width <= EXACT:
        some = np.flatnonzero((customers > width // 2) & (customers <= width))
        k = np.arange(width)
        for at in range(0, len(some), max(1, (1 << 19) // width)):
            d = some[at : at + max(1, (1 << 19) // width)]
            step = np.log(STRENGTH + discount * (others[d][:, None] + k))
            step += np.log(p[d][:, None] + gain[d][:, None] * np.maximum(k - less[d][:, None], 0.0))
            law = np.cumsum(step, axis=1) + ways[customers[d] - 1, :width]
            law = np.cumsum(np.exp(law - law.max(axis=1, keepdims=True)), axis=1)
            t[d] = 1 + (law < rng.random(len(d))[:, None] * law[:, -1:]).sum(axis=1)
        width *= 2
    hot = np.flatnonzero(customers > EXACT)
    for at in range(0, len(hot), 512):
        d = hot[at : at + 512]
        c, base = customers[d].astype(float), STRENGTH / discount + others[d]
        more = p[d] / gain[d] - less[d]

        def law(t: np.ndarray, c=c, base=base, more=more, d=d) -> np.ndarray:
            one = lambda x: x if t.ndim == 1 else x[:, None]
            own = t * np.log(discount) + _log_gamma(one(base) + t) - _log_gamma(one(base))
            parent = (t - 1) * np.log(one(gain[d])) + _log_gamma(one(more) + t) - _log_gamma(one(more) + 1)
            return _log_ways_of(np.broadcast_to(one(c), t.shape), t, discount) + own + parent

        lo, hi = np.ones(len(d)), c - 1  # the law rises up to its mode
        while (lo < hi).any():
            mid = np.floor((lo + hi) / 2)
            rises = law(mid + 1) > law(mid)
            lo, hi = np.where(rises & (lo < hi), mid + 1, lo), np.where(rises | (lo >= hi), hi, mid)
        stride = np.ceil(8 * np.sqrt(lo) / 32)
        grid = lo[:, None] + stride[:, None] * np.arange(-32, 33)
        sound = (grid >= 1) & (grid < c[:, None])
        values = np.where(sound, law(np.clip(grid, 1, c[:, None] - 1)), -np.inf)
        upto = np.cumsum(np.exp(values - values.max(axis=1, keepdims=True)), axis=1)
        cell = (upto < rng.random(len(d))[:, None] * upto[:, -1:]).sum(axis=1)
        inside = np.floor(rng.random(len(d)) * stride) - np.floor((stride - 1) / 2)
        t[d] = np.clip(grid[np.arange(len(d)), cell] + inside, 1, customers[d]).astype(np.int64)
    return t


@dataclass
class Totals:
    """Counts over all training tokens, and the fixed parameters."""

    n: int  # tokens
    v: int  # words
    context: np.ndarray  # customers per class: tables of its contexts
    discount: float  # of the classes
    root_discount: float
    tables: np.ndarray  # tables per class
    root_tables: float
    leaf_discount: float = 0.5  # of the contexts

    def root(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Probability of words with c customers at t tables of the root."""
        customers = float(self.tables.sum())
        new = (STRENGTH + self.root_discount * self.root_tables) / (self.v + 1)
        return (np.maximum(c - self.root_discount * t, 0.0) + new) / (STRENGTH + customers)

    def back_off(self) -> np.ndarray:
        """Weight of the root's probability per class."""
        return (STRENGTH + self.discount * self.tables) / (STRENGTH + self.context)


class Bucket:
    """The seating of one bucket's words: tables of the pairs, of the words in each class, and of the words in the root."""

    def __init__(self, words: np.ndarray, contexts: np.ndarray, counts: np.ndarray):
        """Pairs by rising words."""
        self.counts = counts
        new = np.diff(words, prepend=words[:1] - 1) != 0
        self.words = words[new]
        slot = (np.cumsum(new) - 1) * CLASSES + (contexts & _CLASS_MASK)
        there = np.zeros(len(self.words) * CLASSES, dtype=bool)
        there[slot] = True
        at = np.flatnonzero(there)
        self.word = at // CLASSES
        self.keys = self.words[self.word] | (at & _CLASS_MASK)
        self.dish = (np.cumsum(there, dtype=np.int32) - 1)[slot]
        # To begin with, one table per dish.
        self.t = np.ones(len(words), dtype=np.int64)
        self.class_t, self.root_t = np.ones(len(self.keys), dtype=np.int64), np.ones(len(self.words), dtype=np.int64)

    def slices(self, contexts: np.ndarray, slices: int) -> Iterator[tuple[int, tuple]]:
        """(slice, (its own bucket, positions of its pairs, keys and words)) of the slices of the words."""
        of_word = _bucket(self.words, slices)
        of_key = of_word[self.word]
        levels = [dict(_parts(x, slices)) for x in (of_key[self.dish], of_key, of_word)]
        for i, words in levels[2].items():
            pairs, keys = levels[0][i], levels[1][i]
            some = Bucket(self.words[self.word[self.dish[pairs]]], contexts[pairs], self.counts[pairs])
            some.t, some.class_t, some.root_t = self.t[pairs], self.class_t[keys], self.root_t[words]
            yield i, (some, pairs, keys, words)

    def take(self, some: Bucket, pairs: np.ndarray, keys: np.ndarray, words: np.ndarray) -> None:
        """The tables of a slice."""
        self.t[pairs], self.class_t[keys], self.root_t[words] = some.t, some.class_t, some.root_t

    def class_c(self) -> np.ndarray:
        return np.bincount(self.dish, weights=self.t, minlength=len(self.keys)).astype(np.int64)

    def root_c(self) -> np.ndarray:
        return np.bincount(self.word, weights=self.class_t, minlength=len(self.words)).astype(np.int64)

    def sweep(self, totals: Totals, tables: np.ndarray, rng: np.random.Generator) -> None:
        """Seat all customers anew; ``tables`` are those of each pair's context, over all buckets."""
        context = self.keys & _CLASS_MASK
        class_c, root_c = self.class_c(), self.root_c()
        # The parent without the dish: its customers there leave tables in proportion.
        rest = class_c[self.dish] - self.t
        rest_t = self.class_t[self.dish] * rest / class_c[self.dish]
        word = self.word[self.dish]
        rest_root = root_c[word] - (self.class_t[self.dish] - rest_t)
        root = totals.root(rest_root, self.root_t[word] * rest_root / root_c[word])
        at = context[self.dish]
        size = STRENGTH + totals.context[at]
        p = (np.maximum(rest - totals.discount * rest_t, 0) + (STRENGTH + totals.discount * totals.tables[at]) * root) / size
        less = np.where(rest > 0, 0.0, totals.discount)
        self.t = draw_tables(self.counts, tables - self.t, p, 1 / size, less, totals.leaf_discount, rng)

        class_c = self.class_c()
        rest = root_c[self.word] - self.class_t
        p = totals.root(rest, self.root_t[self.word] * rest / root_c[self.word])
        gain = np.full(len(p), 1 / (STRENGTH + totals.tables.sum()))
        less = np.where(rest > 0, 0.0, totals.root_discount)
        self.class_t = draw_tables(class_c, totals.tables[context] - self.class_t, p, gain, less, totals.discount, rng)

        n = len(self.words)
        base = np.full(n, 1 / (totals.v + 1))  # the base does not change with its draws
        self.root_t = draw_tables(self.root_c(), totals.root_tables - self.root_t, base, base * 1e-12, np.zeros(n), totals.root_discount, rng)


def _added(df: DataFrame, columns: dict[str, int]) -> dict[str, np.ndarray]:
    """Sums of array columns, position by position (one row per task reaches the driver's aggregate)."""
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}_{i}") for c, n in columns.items() for i in range(n)]
    row = df.agg(*sums).first()
    return {c: np.array([row[f"{c}_{i}"] or 0 for i in range(n)], dtype=np.float64) for c, n in columns.items()}


def _discount(ones: float, twos: float) -> float:
    """The usual estimate from counts of counts, kept inside (0, 1)."""
    return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.05, 0.95))


_SAID = "sample int, bucket int, part int, t binary, class_t binary, root_t binary, sums array<long>"
_SAID_COLUMNS = [c.split()[0] for c in _SAID.split(", ")]
_LINKS = "part int, contexts binary, c binary, buckets array<int>, indexes array<binary>"
_STATE = "bucket int, pairs binary, pair_n binary, p_n binary, p binary, keys binary, class_c binary, class_t binary, root_c binary, root_t binary, word_n binary"
_STATE_COLUMNS = [c.split()[0] for c in _STATE.split(", ")]
#: Part of a message that isn't for a context's part: a bucket's own tables, kept for its next sweep.
_OWN = -1


@dataclass
class Model:
    pairs: DataFrame  # per bucket: words, contexts and counts of its pairs
    inbox: DataFrame  # per bucket and kept sample: its tables, and the totals of its contexts
    links: DataFrame  # per part: contexts, their customers, and which of them each bucket has
    totals: DataFrame  # per part: contexts, their customers, their tables per sample
    slices: int
    parts: int
    samples: list[Totals]
    tokens_per_bucket: dict[int, int]

    @property
    def buckets(self) -> int:
        return -(-self.slices // BUCKET_SLICES)

    @property
    def n(self) -> int:
        return self.samples[0].n

    @property
    def v(self) -> int:
        return self.samples[0].v

    @property
    def state(self) -> DataFrame:
        """Per bucket: pairs and their probabilities; the classes' and the root's dishes per sample; words' counts."""

        def run(key, pairs: pd.DataFrame, inbox: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([_finished(pairs.iloc[0], inbox, self_samples, self_parts)])[_STATE_COLUMNS]

        self_samples, self_parts = self.samples, self.parts
        return self.pairs.groupBy("bucket").cogroup(self.inbox.groupBy("bucket")).applyInPandas(run, _STATE)

    @property
    def contexts(self) -> DataFrame:
        """Per part: contexts, their customers, their back-off weights per sample."""
        samples = self.samples

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for _, row in pdf.iterrows():
                    own, c, weight = _back_off(row, samples)
                    yield pd.DataFrame([(row["part"], own.tobytes(), c.tobytes(), weight.tobytes())], columns=["part", "contexts", "c", "weight"])

        return self.totals.mapInPandas(run, "part int, contexts binary, c binary, weight binary")


def _arrays(row, *names: str) -> Iterator[np.ndarray]:
    return (np.frombuffer(row[c], dtype=np.int64) for c in names)


def _back_off(row, samples: list[Totals]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, customers, back-off weights per sample) of a part."""
    c = unpack(row["c"])
    t = unpack(row["t"]).reshape(len(samples), -1)
    weight = (STRENGTH + samples[0].leaf_discount * t) / (STRENGTH + c)
    return unpack(row["contexts"]), c, weight


def _opened(row) -> tuple[Bucket, np.ndarray, np.ndarray]:
    """The bucket of a row; its distinct contexts, and the position of each pair's among them."""
    (own_words, word), (own, index) = unpack_ids(row["words"]), unpack_ids(row["contexts"])
    return Bucket(own_words[word], own[index], unpack(row["counts"])), own, index


def _seated(at: Bucket, inbox: pd.DataFrame, sample: int) -> None:
    """Give the bucket the tables of a sample."""
    row = inbox[(inbox["part"] == _OWN) & (inbox["sample"] == sample)].iloc[0]
    at.t, at.class_t, at.root_t = (unpack(row[c]) for c in ("t", "class_t", "root_t"))


def _received(inbox: pd.DataFrame, own: np.ndarray, parts: int, sample: int) -> np.ndarray:
    """Totals of a bucket's contexts from the parts' replies."""
    some = inbox[(inbox["part"] != _OWN) & (inbox["sample"] == sample)]
    by_part = dict(zip(some["part"], some["t"], strict=True))
    out = np.empty(len(own), dtype=np.int64)
    for part, p in _parts(_bucket(own, parts), parts):
        out[p] = unpack(by_part[part])
    return out


def _says(sample: int, bucket: int, at: Bucket, own: np.ndarray, index: np.ndarray, parts: int) -> pd.DataFrame:
    """A bucket's messages: its tables, and its sums for the classes, the root and the parts of its contexts."""
    context = at.keys & _CLASS_MASK
    class_c = at.class_c()
    per_class = [np.bincount(context, weights=x, minlength=CLASSES).astype(np.int64) for x in (class_c, at.class_t)]
    levels = (at.counts, class_c, at.root_c())
    counts = [int(at.counts.sum()), len(at.words), *(int((c == k).sum()) for c in levels for k in (1, 2))]
    sums = [*per_class[0].tolist(), *per_class[1].tolist(), int(at.root_t.sum()), *counts]
    rows = [(sample, bucket, _OWN, pack(at.t), pack(at.class_t), pack(at.root_t), sums)]
    tables = np.bincount(index, weights=at.t, minlength=len(own)).astype(np.int64)
    rows += [(sample, bucket, part, pack(tables[p]), None, None, None) for part, p in _parts(_bucket(own, parts), parts)]
    return pd.DataFrame(rows, columns=_SAID_COLUMNS)


def _link(pairs: DataFrame, parts: int, tasks: int) -> DataFrame:
    """Every bucket tells the contexts' parts which contexts it has, and how many customers."""

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                own, index = unpack_ids(row["contexts"])
                c = np.bincount(index, weights=unpack(row["counts"]), minlength=len(own)).astype(np.int64)
                rows = [(row["bucket"], part, pack(own[p]), pack(c[p])) for part, p in _parts(_bucket(own, parts), parts)]
                yield pd.DataFrame(rows, columns=["bucket", "part", "contexts", "c"])
        trim()

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket")
        each = [unpack(x) for x in pdf["contexts"]]
        own, index = np.unique(np.concatenate(each), return_inverse=True)
        c = np.bincount(index, weights=np.concatenate([unpack(x) for x in pdf["c"]]), minlength=len(own)).astype(np.int64)
        indexes = [pack(x) for x in np.split(index, np.cumsum([len(e) for e in each])[:-1])]
        row = pdf["part"].iloc[0], pack(own), pack(c), pdf["bucket"].tolist(), indexes
        trim()
        return pd.DataFrame([row], columns=["part", "contexts", "c", "buckets", "indexes"])

    told = pairs.mapInPandas(tell, "bucket int, part int, contexts binary, c binary")
    return stored_by(told.groupBy("part").applyInPandas(link, _LINKS), "links", "part", tasks)


def _added_up(link, sent: pd.DataFrame) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(tables of a part's contexts over all buckets, positions of each bucket's contexts)."""
    index = {b: unpack(x) for b, x in zip(link["buckets"], link["indexes"], strict=True)}
    total = np.zeros(len(unpack(link["c"])), dtype=np.int64)
    for b, t in zip(sent["bucket"], sent["t"], strict=True):
        total[index[b]] += unpack(t)  # a bucket has a context once
    return total, index


def _replies(said: DataFrame, links: DataFrame) -> DataFrame:
    """A sample's messages to the buckets: the totals of their contexts, and what each said to itself."""

    def add(key, link: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        if not len(sent):
            return pd.DataFrame([], columns=_SAID_COLUMNS[:4])
        total, index = _added_up(link.iloc[0], sent)
        sample = sent["sample"].iloc[0]
        out = pd.DataFrame([(sample, b, key[0], pack(total[i])) for b, i in index.items()], columns=_SAID_COLUMNS[:4])
        trim()
        return out

    sent = said.where(F.col("part") != _OWN).select("sample", "bucket", "part", "t")
    heard = links.groupBy("part").cogroup(sent.groupBy("part")).applyInPandas(add, "sample int, bucket int, part int, t binary")
    return said.where(F.col("part") == _OWN).drop("sums").unionByName(heard, allowMissingColumns=True)


#: The ``sample`` of messages that hold customers, which stay the same.
_CUSTOMERS = -1


def _finished(pairs, inbox: pd.DataFrame, samples: list[Totals], parts: int, least: float = 0) -> dict:
    """The state of a bucket: see ``Model.state``; its pairs only where they occur at least ``least`` times."""
    at, own, index = _opened(pairs)
    class_c, class_t, root_c, root_t, tables = [], [], [], [], []
    for s in range(len(samples)):
        _seated(at, inbox, s)
        for out, x in zip((class_c, class_t, root_c, root_t), (at.class_c(), at.class_t, at.root_c(), at.root_t), strict=True):
            out.append(x)
        tables.append(at.t)
    word = at.word[at.dish]
    word_n = np.bincount(word, weights=at.counts, minlength=len(at.words)).astype(np.int64)
    levels = {"class_c": class_c, "class_t": class_t, "root_c": root_c, "root_t": root_t}
    out = {"keys": at.keys.tobytes(), "word_n": word_n.tobytes()} | {k: np.stack(x).tobytes() for k, x in levels.items()}
    of_class = _Words(out, samples).by_sample(at.keys)
    customers = _received(inbox, own, parts, _CUSTOMERS)
    some = np.flatnonzero(at.counts >= least)
    counts, dish, word, context = at.counts[some], at.dish[some], word[some], index[some]
    p, leaf = np.zeros(len(some)), samples[0].leaf_discount
    for s in range(len(samples)):
        total = _received(inbox, own, parts, s)
        mine = np.maximum(counts - leaf * tables[s][some], 0.0) + (STRENGTH + leaf * total[context]) * of_class[s][dish]
        p += mine / (STRENGTH + customers[context]) / len(samples)
    out |= {"bucket": pairs["bucket"], "pairs": _pair(at.words[word], own[context]).tobytes(), "pair_n": counts.tobytes()}
    out |= {"p_n": word_n[word].tobytes(), "p": p.tobytes()}
    trim()
    return out


def fit(docs: DataFrame, burn_in: int = 2, samples: int = 2, seed: int = 8) -> Model:
    """Learn from all rows of ``docs`` (text)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    # A dish takes some tokens of some bytes: a slice of this many bytes has about SLICE_DISHES.
    slices = max(1, -(-size // (SLICE_DISHES * 16)))
    buckets = -(-slices // BUCKET_SLICES)
    # Contexts are far fewer than pairs; every bucket writes to every part.
    parts = max(min(buckets, 64), buckets // 8)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets)
    counted = docs.select("text").mapInPandas(_count(slices), _COUNTS).repartition(tasks, "bucket").mapInPandas(_merge, _COUNTS)
    pairs = stored_by(counted, "pairs", "bucket", tasks)
    links = _link(pairs, parts, tasks)

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                yield _says(0, row["bucket"], *_opened(row), parts)
        trim()

    said = stored(pairs.mapInPandas(begin, _SAID), "said")

    def sums_of(said: DataFrame) -> np.ndarray:
        return _added(said.where(F.col("part") == _OWN), {"sums": 2 * CLASSES + 9})["sums"]

    first = sums_of(said)
    flat = first[2 * CLASSES + 1 :]
    own = said.where(F.col("part") == _OWN).select("bucket", F.get("sums", F.lit(2 * CLASSES + 1)).alias("n"))
    per_bucket = {r["bucket"]: r["n"] for r in own.collect()}  # one number per bucket
    n, v = int(flat[0]), int(flat[1])
    leaf, of_class, of_root = (_discount(*flat[i : i + 2]) for i in (2, 4, 6))

    def totals_of(sums: np.ndarray) -> Totals:
        return Totals(n, v, sums[:CLASSES], of_class, of_root, sums[CLASSES : 2 * CLASSES], float(sums[2 * CLASSES]), leaf)

    def swept(number: int, totals: Totals):
        sample = max(number - burn_in, 0)

        def run(key, state: pd.DataFrame, inbox: pd.DataFrame) -> pd.DataFrame:
            at, own, index = _opened(state.iloc[0])
            _seated(at, inbox, inbox["sample"].iloc[0])
            tables = _received(inbox, own, parts, inbox["sample"].iloc[0])[index]
            for i, some in at.slices(own[index], slices):
                some[0].sweep(totals, tables[some[1]], np.random.default_rng([seed, number, i]))
                at.take(*some)
            out = _says(sample, key[0], at, own, index, parts)
            trim()
            return out

        return run

    kept, totals = [], totals_of(first)
    for number in range(burn_in + samples):
        inbox = _replies(said, links)
        said = stored(pairs.groupBy("bucket").cogroup(inbox.groupBy("bucket")).applyInPandas(swept(number, totals), _SAID), "said")
        totals = totals_of(sums_of(said))
        if number >= burn_in:
            kept.append((said, totals))

    def customers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                c = unpack(row["c"])
                rows = [(_CUSTOMERS, b, row["part"], pack(c[unpack(i)])) for b, i in zip(row["buckets"], row["indexes"], strict=True)]
                yield pd.DataFrame(rows, columns=_SAID_COLUMNS[:4])

    inbox = links.mapInPandas(customers, "sample int, bucket int, part int, t binary")
    every = functools.reduce(DataFrame.unionByName, [said for said, _ in kept])
    for said, _ in kept:
        inbox = inbox.unionByName(_replies(said, links), allowMissingColumns=True)

    def whole(key, link: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        t = [_added_up(link.iloc[0], sent[sent["sample"] == s])[0] for s in range(samples)]
        return pd.DataFrame([(key[0], link["contexts"].iloc[0], link["c"].iloc[0], pack(np.concatenate(t)))], columns=["part", "contexts", "c", "t"])

    sent = every.where(F.col("part") != _OWN).select("sample", "bucket", "part", "t")
    totals = links.groupBy("part").cogroup(sent.groupBy("part")).applyInPandas(whole, "part int, contexts binary, c binary, t binary")
    return Model(pairs, stored(inbox, "inbox"), links, stored(totals, "totals"), slices, parts, [x for _, x in kept], per_bucket)


class _Words:
    """Probabilities of one bucket's words in the classes, and of its pairs."""

    def __init__(self, row, samples: list[Totals]):
        self.samples = samples
        per = lambda name: np.frombuffer(row[name], dtype=np.int64).reshape(len(samples), -1)
        self.keys, self.count = _arrays(row, "keys", "word_n")
        self.words = np.unique(self.keys & ~_CLASS_MASK)
        self.root = np.stack([s.root(c, t) for s, c, t in zip(samples, per("root_c"), per("root_t"), strict=True)])
        context = self.keys & _CLASS_MASK
        own = [np.maximum(c - s.discount * t, 0.0) / (STRENGTH + s.context[context]) for s, c, t in zip(samples, per("class_c"), per("class_t"), strict=True)]
        self.own = np.stack(own)
        self.back_off = np.stack([s.back_off() for s in samples])

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, whether there) of words."""
        at = np.minimum(np.searchsorted(self.words, words), max(len(self.words) - 1, 0))
        return at, (self.words[at] == words) if len(self.words) else np.zeros(len(words), dtype=bool)

    def by_sample(self, keys: np.ndarray) -> np.ndarray:
        """Probabilities of word | class keys in every sample."""
        context = keys & _CLASS_MASK
        at, known = self.find(keys & ~_CLASS_MASK)
        p = np.zeros((len(self.samples), len(keys)))
        if len(self.words):
            dish = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            p += np.where(self.keys[dish] == keys, self.own[:, dish], 0.0)
        for s, totals in enumerate(self.samples):
            unknown = totals.root(np.zeros(1), np.zeros(1))[0]
            p[s] += self.back_off[s][context] * (np.where(known, self.root[s][at], unknown) if len(self.words) else unknown)
        return p

    def counts(self, words: np.ndarray) -> np.ndarray:
        """Training counts of words."""
        at, known = self.find(words)
        return np.where(known, self.count[at], 0) if len(self.words) else np.zeros(len(words), dtype=np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training count of the word, probability in the class) of word | class keys."""
        return self.counts(keys & ~_CLASS_MASK), self.by_sample(keys).mean(axis=0)


def _base(count: np.ndarray, n: int, v: int) -> np.ndarray:
    return np.log10((count + 0.1) / (n + 0.1 * (v + 1)))


def _least(df: DataFrame, column: str, n: int) -> float:
    """A count that at most MAX_FREQUENT entries of the packed ``column`` reach, the smallest one below TALLIED."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for raw in pdf[column]:
                count, entries = np.unique(np.minimum(unpack(raw), TALLIED), return_counts=True)
                yield pd.DataFrame({"count": count, "entries": entries})

    counts = df.select(column).mapInPandas(tally, "count long, entries long").groupBy("count").agg(F.sum("entries").alias("entries"))
    least, above = max(1.0, n / MAX_FREQUENT), 0
    for r in counts.orderBy(F.desc("count")).collect():  # at most TALLIED rows
        above += r["entries"]
        if above > MAX_FREQUENT:
            break
        least = min(least, float(r["count"]))
    return least


def _frequent(model: Model) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(sorted pairs, their words' counts, log10 probabilities) and (sorted contexts, back-off weights) of the frequent."""
    samples, parts = model.samples, model.parts
    least, least_c = _least(model.pairs, "counts", model.n), _least(model.totals, "c", model.n)

    def pairs(key, row: pd.DataFrame, inbox: pd.DataFrame) -> pd.DataFrame:
        at = _finished(row.iloc[0], inbox, samples, parts, least)
        own, word_n = _arrays(at, "pairs", "p_n")
        return pd.DataFrame({"pair": own, "count": word_n, "p": np.log10(np.frombuffer(at["p"], dtype=np.float64))})

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                own, c, weight = _back_off(row, samples)
                some = np.flatnonzero(c >= least_c)
                if len(some):
                    yield pd.DataFrame({"context": own[some], "weight": list(weight[:, some].T)})

    # At most MAX_FREQUENT rows each.
    got = model.pairs.groupBy("bucket").cogroup(model.inbox.groupBy("bucket")).applyInPandas(pairs, "pair long, count long, p double")
    got = got.toPandas().sort_values("pair")
    those = model.totals.mapInPandas(contexts, "context long, weight array<double>").toPandas().sort_values("context")
    weight = np.stack(those["weight"].to_numpy(), axis=1) if len(those) else np.zeros((len(samples), 0))
    return (
        (got["pair"].to_numpy(dtype=np.int64), got["count"].to_numpy(dtype=np.int64), got["p"].to_numpy(dtype=np.float64)),
        (those["context"].to_numpy(dtype=np.int64), weight),
    )


def _find(own: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(own, keys), max(len(own) - 1, 0))
    return at, (own[at] == keys) if len(own) else np.zeros(len(keys), dtype=bool)


def _mask(own: np.ndarray) -> np.ndarray:
    """Which upper bits occur."""
    mask = np.zeros(1 << 22, dtype=bool)
    mask[own.view(np.uint64) >> np.uint64(42)] = True
    return mask


def score(model: Model, docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_frequent(model))  # MAX_FREQUENT pairs and contexts
    n, v, slices, buckets, parts, samples = model.n, model.v, model.slices, model.buckets, model.parts, model.samples
    id_mark = F.coalesce(F.col("doc_id").cast("string"), F.lit("\0"))
    marked = docs.select("doc_id", "text", F.xxhash64(id_mark, F.coalesce("text", F.lit("\0"))).alias("mark"))
    sums_of = "n_tokens binary, n_known binary, base binary, p binary"
    sum_columns = [c.split()[0] for c in sums_of.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per chunk of texts: the sums of the frequent pairs, in one row with the texts' marks; the other tokens by bucket."""
        pairs, pair_words, log_p = shared.value[0]
        mask, base = _mask(pairs), _base(pair_words, n, v)
        number = TaskContext.get().partitionId() << 32
        held, marks, sums, size, first = [], [], [], 0, 0
        columns = ["bucket", "chunk", "words", "contexts", "text", "marks", *sum_columns]

        def rows() -> pd.DataFrame:
            words, contexts, text = (np.concatenate(x) for x in zip(*held, strict=True))
            n_tokens, n_known, base, p = (np.concatenate(x) for x in zip(*sums, strict=True))
            own = np.concatenate(marks).tobytes(), pack(n_tokens), pack(n_known), base.tobytes(), p.tobytes()
            out = []
            for b, part in _parts(_dealt(words, slices), buckets):
                part = part[np.argsort(words[part])]
                out.append((b, number, pack_ids(words[part]), pack_ids(contexts[part]), pack(text[part]), *([None] * 5 if out else own)))
            empty = np.zeros(0, dtype=np.int64)
            out = out or [(number % buckets, number, pack_ids(empty), pack_ids(empty), pack(empty), *own)]
            return pd.DataFrame(out, columns=columns)

        for pdf in blocks(batches):
            words, contexts, per_text = tokens(pdf["text"].tolist())
            pair = _pair(words, contexts)
            found = mask[pair.view(np.uint64) >> np.uint64(42)]
            at, there = _find(pairs, pair[found])
            found[found], at = there, at[there]
            text = np.repeat(np.arange(len(per_text)), per_text)
            total = lambda x: np.bincount(text[found], weights=x, minlength=len(per_text))  # noqa: E731, B023
            known = np.bincount(text[found], minlength=len(per_text))
            sums.append((per_text, known, total(base[at]), total(log_p[at])))
            held.append((words[~found], contexts[~found], text[~found] + first))
            marks.append(pdf["mark"].to_numpy(dtype=np.int64))
            first += len(per_text)
            size += int((~found).sum())
            if size >= HELD or first >= HELD:
                yield rows()
                held, marks, sums, size, first = [], [], [], 0, 0
                number += 1
        if first:
            yield rows()

    event = "bucket int, chunk long, words binary, contexts binary, text binary, marks binary, " + sums_of
    events = marked.select("text", "mark").mapInPandas(read, event)
    summed = f"chunk long, place long, text binary, marks binary, {sums_of}"
    packed = f"{summed}, part int, chunks binary, contexts binary, classes binary, size long"
    out_columns, late_columns = ([c.split()[0] for c in x.split(", ")] for x in (packed, summed))

    def meet(key, row_: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        """Sums per chunk and text; and, per part of the contexts, the tokens that wait for their context's weight."""
        out = []
        tokens_ = mail[mail["chunk"].notna()].sort_values("chunk")
        if not len(tokens_):
            return pd.DataFrame(out, columns=out_columns)
        if len(row_):
            row = _finished(row_.iloc[0], mail[mail["chunk"].isna()], samples, parts)
        else:
            row = dict.fromkeys(("pairs", "p", "keys", "class_c", "class_t", "root_c", "root_t", "word_n"), b"")
        known = _Words(row, samples)
        (pairs,) = _arrays(row, "pairs")
        order = np.argsort(pairs)
        pairs, own_p = pairs[order], np.log10(np.frombuffer(row["p"], dtype=np.float64)[order])
        often, weight = shared.value[1]
        late = []
        for chunk, w, c, t, *first in zip(*(tokens_[x] for x in ("chunk", "words", "contexts", "text", "marks", *sum_columns)), strict=True):
            chunk = int(chunk)
            if first[0] is not None:
                out.append((chunk, -1, None, *first, None, None, None, None, 0))
            (own_words, word), (own_contexts, context), token = unpack_ids(w), unpack_ids(c), unpack(t)
            if not len(token):
                continue
            words, contexts = own_words[word], own_contexts[context]
            pair = _pair(words, contexts)
            order = np.argsort(pair)  # sorted ones are found faster
            at, seen = _find(pairs, pair[order])
            p = np.zeros(len(words))
            p[order[seen]] = own_p[at[seen]]
            new = np.sort(order[~seen])
            of_class = known.by_sample(words[new] | (contexts[new] & _CLASS_MASK))
            where, there = _find(often, contexts[new])
            p[new[there]] = np.log10((weight[:, where[there]] * of_class[:, there]).mean(axis=0))
            count = known.counts(own_words)
            tokens_of = np.bincount(token)
            texts = np.flatnonzero(tokens_of)
            total = lambda x: np.bincount(token, weights=x)[texts]  # noqa: E731, B023
            unknown = total((count == 0)[word]).astype(np.int64)
            sums = None, pack(tokens_of[texts] - unknown), total(_base(count, n, v)[word]).tobytes(), total(p).tobytes()
            out.append((chunk, int(key[0]), pack(texts), None, *sums, None, None, None, None, 0))
            new, of_class = new[~there], of_class[:, ~there]
            late.append((np.full(len(new), chunk), token[new], contexts[new], of_class))
        if late:
            chunks, token, contexts = (np.concatenate(x) for x in list(zip(*late, strict=True))[:3])
            of_class = np.concatenate([x[3] for x in late], axis=1)
            for part, pos in _parts(_bucket(contexts, parts), parts):
                arrays = pack_ids(chunks[pos]), pack_ids(contexts[pos]), np.ascontiguousarray(of_class[:, pos]).tobytes()
                out.append((None, int(key[0]), pack(token[pos]), *[None] * 5, part, *arrays, len(pos)))
        trim()
        return pd.DataFrame(out, columns=out_columns).astype({"part": "Int32", "chunk": "Int64"})

    def weigh(key, waiting: pd.DataFrame, contexts_: pd.DataFrame) -> pd.DataFrame:
        """Sums of the tokens that wait, their contexts' weights at hand; a context never seen leaves all to its class."""
        late, out = [], []
        own, weight = np.zeros(0, dtype=np.int64), np.zeros((len(samples), 0))
        if len(contexts_):
            own, _, weight = _back_off(contexts_.iloc[0], samples)
        waiting = waiting.sort_values("place")
        for t, k, c, p in zip(*(waiting[x] for x in ("text", "chunks", "contexts", "classes")), strict=True):
            (own_chunks, chunk), (mine, context) = unpack_ids(k), unpack_ids(c)
            at, there = (x[context] for x in _find(own, mine))
            of_class = np.frombuffer(p, dtype=np.float64).reshape(len(samples), -1)
            both = (np.where(there, weight[:, at], 1.0) if len(own) else 1.0) * of_class
            late.append((own_chunks[chunk], unpack(t), np.log10(both.mean(axis=0))))
        if late:
            chunks, token, p = (np.concatenate(x) for x in zip(*late, strict=True))
            own_chunks, chunk = np.unique(chunks, return_inverse=True)
            for i, pos in _parts(chunk, len(own_chunks)):
                texts, text = np.unique(token[pos], return_inverse=True)
                none = np.zeros(len(texts))
                sums = pack(none), none.tobytes(), np.bincount(text, weights=p[pos]).tobytes()
                out.append((int(own_chunks[i]), buckets + int(key[1]) * parts + int(key[0]), pack(texts), None, None, *sums))
        trim()
        return pd.DataFrame(out, columns=late_columns)

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        """The sums of a chunk's texts over all buckets, added up in the order of the buckets, the frequent pairs' first."""
        pdf = pdf.sort_values("place")
        row, rest = pdf.iloc[0], pdf.iloc[1:]
        out = {"mark": np.frombuffer(row["marks"], dtype=np.int64), "n_tokens": unpack(row["n_tokens"]), "n_known": unpack(row["n_known"]).copy()}
        out |= {c: np.frombuffer(row[c], dtype=np.float64).copy() for c in ("base", "p")}
        for texts, known, base, p in zip(*(rest[c] for c in ("text", "n_known", "base", "p")), strict=True):
            at = unpack(texts)  # a text once
            out["n_known"][at] += unpack(known)
            out["base"][at] += np.frombuffer(base, dtype=np.float64)
            out["p"][at] += np.frombuffer(p, dtype=np.float64)
        return pd.DataFrame(out)

    events, inbox, state, keys = marked.select("text", "mark").mapInPandas(read, event), model.inbox, model.pairs, ["bucket"]
    # A bucket of many tokens is split by salt; its words go to every part.
    salts = {b: -(-t // BUCKET_TOKENS) for b, t in model.tokens_per_bucket.items() if t > BUCKET_TOKENS}
    if salts:
        split = F.lit(1)
        for b, k in salts.items():
            split = F.when(F.col("bucket") == b, k).otherwise(split)
        events = events.withColumn("salt", F.pmod(F.xxhash64("chunk"), split).cast("int"))
        inbox, state = (df.withColumn("salt", F.explode(F.sequence(F.lit(0), split - 1))) for df in (inbox, state))
        keys = ["bucket", "salt"]
    mail = events.unionByName(inbox, allowMissingColumns=True)
    met = stored(state.groupBy(*keys).cogroup(mail.groupBy(*keys)).applyInPandas(meet, packed), "met")
    waiting, most = met.where("part IS NOT NULL"), max(1, BUCKET_TOKENS // 4)
    many = waiting.groupBy("part").agg(F.sum("size").alias("n")).where(F.col("n") > most).collect()  # one number per part
    split = F.lit(1)
    for r in many:
        split = F.when(F.col("part") == r["part"], -(-r["n"] // most)).otherwise(split)
    waiting = waiting.withColumn("salt", F.pmod(F.xxhash64("place"), split).cast("int"))
    weights = model.totals.withColumn("salt", F.explode(F.sequence(F.lit(0), (split - 1).cast("int"))))
    late = waiting.groupBy("part", "salt").cogroup(weights.groupBy("part", "salt")).applyInPandas(weigh, summed)
    sums = met.where("part IS NULL").select(*late.columns).unionByName(late)
    # A chunk has some millions of tokens at most (or one text), so it is a group of bounded size.
    sums = sums.groupBy("chunk").applyInPandas(gather, "mark long, n_tokens long, n_known long, base double, p double")
    # Equal rows brought their sums once each: count them to share these.
    total = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "p")]
    sums = sums.groupBy("mark").agg(F.count("*").alias("rows"), *total)
    whole = marked.groupBy("doc_id", "mark").agg(F.count("*").alias("copies"))
    # One row per copy again.
    joined = expand_copies(whole.join(sums, "mark"), "copies", "copy")
    count = lambda c: F.round(F.col(c) / F.col("rows")).cast("bigint").alias(c)
    return joined.select(
        "doc_id",
        count("n_tokens"),
        count("n_known"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("p") / F.col("rows")).alias("score"),
    )
