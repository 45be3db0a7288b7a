"""Exact Jaccard self-join of word-shingle sets by universe-partition pigeonhole.

A document's set holds its distinct shingles (``width`` words, A-Z lowered) as
64-bit hashes; two sets link when den * |both| >= num * |either|. Linked sets x
and y differ in at most h = (|x| + |y|)(den - num)/(den + num) shingles.

Schemes. Sizes are cut into bands whose upper ends grow by den/num, so linked
sets are in the same or in neighbouring bands. Band k has a scheme; its own
sets take part in it, and so do those sets of band k+1 that are small enough,
so every link is found in the scheme of its smaller set. A scheme hashes the
universe into m segments and describes a set by signatures, one of

* singles: every shingle is its own segment; the prefix |x| - need + 1 of them
  in a global order is indexed (sets of up to ``TINY`` shingles);
* subsets: m = 2H + 1 segments, H the largest h of the scheme. At most h of
  them differ, so at least m - h are equal, and among the h + 1 first of each
  set in a global order of segment contents one is common. The order is a cost
  order: segments made of frequent shingles only come last, empty ones after
  them, so up to H costly segments of a set are never indexed;
* deletions: m = floor(H/2) + 1 segments, of which one differs in at most one
  shingle, and its contents with and without each one shingle are indexed.

For the bands between, the cheaper of the last two is chosen by the signatures
and colliding pairs of a sample of documents (one in ``SAMPLE``). What is
frequent comes from the same sample. Both only steer cost: any order and
either choice finds every link.

Candidates. Sets that share a signature meet in one bucket; equal sets are one
entry. A group of up to ``GROUP`` sets gives all its pairs of fitting size. In
a larger group the least set meets all others, and after the links found so
far are joined to components, only pairs of different components of that group
remain, unless parity sketches of the two sets differ in more than h bits (no
two sets that differ in h shingles do; a sketch bit is the parity of the
shingles hashed to it): for each member first the pair that looks most alike,
then, after joining what these have linked, all that are left. A pair left out
is thus connected already or no link: the components are exact. Every
candidate is verified on the full sets.

Null or empty texts have an empty set, no links, and are their own component.
Texts of fewer words than ``width`` have one shingle, the whole sequence. Null
ids take part and are never a component's name unless all its ids are null.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Words, blocks, fold, mix, stored, trim
from strata.llm.components import components

WIDTH, NUM, DEN = 5, 75, 100
TINY = 16
#: Sets over this many shingles always use subsets: their deletion signatures outnumber them.
DELETIONS_UP_TO = 200
SAMPLE = 16
#: Sampled documents that make a shingle frequent.
FREQUENT = 3
GROUP = 32
TILE = 1024
#: Bits of a parity sketch.
SKETCH_BITS = 4096
#: Bits of the Bloom filters that are sent to the tasks (fixed; a fuller filter costs time, never links).
BLOOM_BITS = 1 << 25
#: Signatures that a task holds before it sends them on.
FLUSH = 1 << 20
#: Signatures per bucket; a task holds one bucket at a time.
BUCKET_ENTRIES = 1_000_000
SINGLES, SUBSETS, DELETIONS = 0, 1, 2
_EXACT, _BIG = 1, 2  # flags of an entry: contents without deletion; part of a large group


# ---- sets -------------------------------------------------------------------------------------------------------


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts)
    words = w.hashes()
    n = len(words)
    base = np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        h = h * base + words[k : k + len(h)]
    h = mix(h)
    out = []
    for a, b in zip(w.first, w.first[1:], strict=False):
        if b - a >= width:
            out.append(np.unique(h[a : b - width + 1]))
        elif b > a:
            whole = np.array([b - a], dtype=np.uint64)  # an array: its arithmetic wraps silently
            for k in range(a, b):
                whole = whole * base + words[k : k + 1]
            out.append(mix(whole ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_id(hashes: np.ndarray) -> int:
    """64-bit fingerprint of a set."""
    total = np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))])
    return int(mix(total).view(np.int64)[0])


def _sketch(hashes: np.ndarray) -> bytes:
    """Parities of the shingles per hash bucket, as SKETCH_BITS bits."""
    bucket = (mix(hashes) >> np.uint64(16)) % np.uint64(SKETCH_BITS)
    odd = np.bincount(bucket.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def set_ids(text: Column, width: int = WIDTH, sketches: bool = False) -> Column:
    """Struct (n_shingles, sid, sketch) of a text's set; sid is null if the set is empty, sketch if not asked for."""

    @F.pandas_udf("n_shingles long, sid long, sketch binary")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n, ids, marks = [], [], []
            for block in blocks(iter([texts.to_frame("text")])):
                for s in shingle_sets(block["text"].tolist(), width):
                    n.append(len(s))
                    ids.append(set_id(s) if len(s) else None)
                    marks.append(_sketch(s) if len(s) and sketches else None)
            columns = {"n_shingles": np.array(n, dtype=np.int64), "sid": pd.array(ids, dtype="Int64")}
            yield pd.DataFrame(columns | {"sketch": pd.Series(marks, dtype=object)})

    return udf.asNondeterministic()(text)


# ---- schemes ----------------------------------------------------------------------------------------------------


@functools.cache
def band_ends(num: int = NUM, den: int = DEN, upto: int = 1 << 40) -> np.ndarray:
    """Largest size of each band."""
    ends = [1]
    while ends[-1] < upto:
        ends.append(max(ends[-1] + 1, ends[-1] * den // num))
    return np.array(ends, dtype=np.int64)


class Schemes:
    """Signatures of sets; ``deletion_bands`` are the bands that use one-deletion neighbourhoods."""

    def __init__(self, deletion_bands: frozenset[int], frequent: np.ndarray | None, num: int = NUM, den: int = DEN):
        self.deletion_bands, self.frequent, self.num, self.den = deletion_bands, frequent, num, den

    def differing(self, both_sizes: int) -> int:
        return both_sizes * (self.den - self.num) // (self.den + self.num)

    def roles(self, size: int) -> list[tuple[int, int]]:
        """(band, largest h) of the schemes that a set of this size takes part in."""
        ends = band_ends(self.num, self.den)
        own = int(np.searchsorted(ends, size))
        out = [(own, self.differing(size + size * self.den // self.num))]
        if own and size * self.num <= int(ends[own - 1]) * self.den:
            out.append((own - 1, self.differing(size + int(ends[own - 1]))))
        return out

    def kind(self, band: int) -> int:
        end = int(band_ends(self.num, self.den)[band])
        return SINGLES if end <= TINY else DELETIONS if band in self.deletion_bands else SUBSETS

    def costly(self, hashes: np.ndarray) -> np.ndarray:
        if self.frequent is None:
            return np.zeros(len(hashes), dtype=bool)
        return in_bloom(self.frequent, hashes)

    def signatures(self, hashes: np.ndarray, costly: np.ndarray | None = None, kinds: dict[int, int] | None = None):
        """(band, kind, signatures, exact flags) per role of the set."""
        size = len(hashes)
        costly = self.costly(hashes) if costly is None else costly
        mixed = mix(hashes)
        for band, h in self.roles(size):
            kind = self.kind(band) if kinds is None else kinds.get(band, self.kind(band))
            end = int(band_ends(self.num, self.den)[band])
            cap = self.differing(end + end * self.den // self.num)
            salt = np.uint64((band * 4 + kind + 1) * 0x9E3779B97F4A7C15 % 2**64)
            if kind == SINGLES:
                need = -(-self.num * size // self.den)
                order = np.lexsort((mixed, costly))
                sig = mix(mixed[order[: size - need + 1]] + salt)
                yield band, kind, sig, np.ones(len(sig), dtype=bool)
                continue
            m = 2 * cap + 1 if kind == SUBSETS else cap // 2 + 1
            segment = ((mixed >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
            order = np.argsort(segment, kind="stable")
            at = segment[order]
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            filled = at[first]
            total = np.add.reduceat(mixed[order], first)
            place = mix(filled.astype(np.uint64) + salt)
            content = mix(total + place)
            if kind == SUBSETS:
                cheap = np.logical_and.reduceat(costly[order], first)
                rank = np.lexsort((content, cheap))[: h + 1]
                sig = content[rank]
                if len(sig) < h + 1:  # too few filled segments: empty ones are next in the order
                    empty = np.setdiff1d(np.arange(m), filled)[: h + 1 - len(sig)]
                    sig = np.r_[sig, mix(empty.astype(np.uint64) + salt + np.uint64(1))]
                yield band, kind, sig, np.ones(len(sig), dtype=bool)
            else:
                owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, size]))
                without = mix(total[owner] - mixed[order] + place[owner])
                empty = np.setdiff1d(np.arange(m), filled)
                bare = mix(mix(empty.astype(np.uint64) + salt))  # contents of nothing: also a single shingle's deletion
                sig = np.r_[content, bare, without]
                exact = np.arange(len(sig)) < len(content) + len(bare)
                yield band, kind, sig, exact


def in_bloom(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    mask = np.uint64(BLOOM_BITS - 1)
    out = np.ones(len(values), dtype=bool)
    for shift in (0, 32):
        pos = (values.view(np.uint64) >> np.uint64(shift)) & mask
        out &= (words[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1) == 1
    return out


def bloom(values: DataFrame, col: str) -> np.ndarray:
    """Bloom filter of a column of mixed 64-bit values; at most BLOOM_BITS / 64 rows reach the driver."""
    positions = F.explode(
        F.array(*[F.shiftrightunsigned(F.col(col), s).bitwiseAND(F.lit(BLOOM_BITS - 1)) for s in (0, 32)])
    )
    at = values.select(positions.alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("b"))
    got = words.toPandas()
    out = np.zeros(BLOOM_BITS // 64, dtype=np.uint64)
    out[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def plan_schemes(docs: DataFrame, width: int, num: int, den: int) -> Schemes:
    """Frequent shingles and the choice per band, from every SAMPLE-th document by hash of its id."""

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in blocks(batches):
            for s in shingle_sets(pdf["text"].tolist(), width):
                if len(s):
                    yield pd.DataFrame({"size": [len(s)], "hashes": [s.view(np.int64)]})

    sample = docs.where(fold(SAMPLE) == SAMPLE // 2).select("text")
    sample = stored(sample.mapInPandas(_merged(sampled), "size long, hashes array<long>"), "sample")
    counted = sample.select(F.explode("hashes").alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    frequent = bloom(counted.where(F.col("n") >= FREQUENT), "x")
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # BLOOM_BITS

    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        schemes = Schemes(frozenset(), shared.value, num, den)
        for pdf in batches:
            out = {"band": [], "kind": [], "sig": []}
            for h in pdf["hashes"]:
                h = np.asarray(h, dtype=np.int64).view(np.uint64)
                costly = schemes.costly(h)
                for kind in (SUBSETS, DELETIONS):
                    kinds = {b: kind for b, _ in schemes.roles(len(h)) if schemes.kind(b) != SINGLES}
                    for band, k, sig, _ in schemes.signatures(h, costly, kinds):
                        if band in kinds:
                            out["band"].append(np.full(len(sig), band, dtype=np.int32))
                            out["kind"].append(np.full(len(sig), k, dtype=np.int32))
                            out["sig"].append(sig.view(np.int64))
            if out["sig"]:
                yield pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})

    middle = sample.where((F.col("size") > TINY) & (F.col("size") <= DELETIONS_UP_TO))
    groups = middle.mapInPandas(both, "band int, kind int, sig long").groupBy("band", "kind", "sig").agg(F.count("*").alias("n"))
    # A signature of the sample stands for SAMPLE signatures, a pair for SAMPLE^2 pairs.
    cost = groups.groupBy("band", "kind").agg(F.sum(F.col("n") * SAMPLE + F.col("n") * (F.col("n") - 1) / 2 * SAMPLE * SAMPLE).alias("cost"))
    costs = {(r["band"], r["kind"]): float(r["cost"]) for r in cost.collect()}  # two rows per band
    better = frozenset(b for b, k in costs if k == DELETIONS and costs[b, k] < costs.get((b, SUBSETS), np.inf))
    return Schemes(better, frequent, num, den)


def _merged(make, rows: int = 512):
    """Fewer, larger frames out of a generator of small ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = []
        for pdf in make(batches):
            kept.append(pdf)
            if len(kept) >= rows:
                yield pd.concat(kept, ignore_index=True)
                kept = []
        if kept:
            yield pd.concat(kept, ignore_index=True)

    return run


# ---- candidates -------------------------------------------------------------------------------------------------

_BLOB = "bucket int, kind int, " + ", ".join(f"{c} binary" for c in ("keys", "flags", "sids", "sizes", "counts"))
_SIG, _PAIR, _ENTRY = 0, 1, 2


class Buckets:
    """Deals the signatures of each band to a run of buckets in proportion to the band's load.

    A document takes part in two bands, so its signatures meet few buckets. An
    entry carries 32 bits of its signature inside the bucket; a chance match is
    only one more candidate.
    """

    def __init__(self, loads: np.ndarray, n: int):
        """``loads`` per band; ``n`` buckets."""
        share = loads / max(loads.sum(), 1)
        self.n, self.width = n, share * n
        self.first = np.cumsum(self.width) - self.width

    def place(self, band: int, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, key) of signatures of a band."""
        part = (sig >> np.uint64(32)).astype(np.float64) / 2.0**32
        bucket = np.minimum((self.first[band] + part * self.width[band]).astype(np.int64), self.n - 1)
        return bucket, (sig & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _band_loads(ids: DataFrame, num: int, den: int) -> np.ndarray:
    """About the number of signatures per band (own ones, and those of the next band)."""
    ends = band_ends(num, den).tolist()
    band = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e < F.col("n_shingles")))
    rows = ids.where("n_shingles > 0").groupBy(band.alias("band")).agg(F.sum("n_shingles").alias("n")).collect()
    load = np.zeros(len(ends) + 1)
    for r in rows:
        load[r["band"]] = r["n"]
    # A band without sets of its own gets a little, for what only chance or a change of the data brings.
    return np.maximum(load[:-1] / 3 + load[1:] / 4, load.sum() * 1e-6)


def _fits(x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
    x, y = x.astype(np.int64), y.astype(np.int64)
    return den * np.minimum(x, y) >= num * np.maximum(x, y)


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((hi, lo))
    lo, hi = lo[order], hi[order]
    new = np.ones(len(lo), dtype=bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return lo[new], hi[new]


class Grouped:
    """Entries (sig, sid, size, flags) by signature, equal sets once, groups of at least two sets."""

    def __init__(self, sig: np.ndarray, sid: np.ndarray, size: np.ndarray, flags: np.ndarray):
        order = np.argsort(sig, kind="stable")
        sorted_sig = sig[order]
        twin = np.zeros(len(sig), dtype=bool)
        same = sorted_sig[1:] == sorted_sig[:-1]
        twin[1:] |= same
        twin[:-1] |= same
        self.alone = order[~twin]
        some = order[twin]
        some = some[np.lexsort((sid[some], sig[some]))]
        self.sig, self.sid, self.size, flags = sig[some], sid[some], size[some], flags[some]
        new = np.ones(len(some), dtype=bool)
        new[1:] = (self.sig[1:] != self.sig[:-1]) | (self.sid[1:] != self.sid[:-1])
        keep = np.flatnonzero(new)
        self.flags = np.bitwise_or.reduceat(flags, keep) if len(keep) else flags
        self.sig, self.sid, self.size = self.sig[keep], self.sid[keep], self.size[keep]
        self.first = np.flatnonzero(np.r_[True, self.sig[1:] != self.sig[:-1]]) if len(keep) else np.zeros(0, dtype=np.int64)
        self.count = np.diff(np.r_[self.first, len(self.sig)])
        self.any = np.bitwise_or.reduceat(self.flags, self.first) if len(self.first) else self.flags

    def members(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, its group's first entry) of all entries of the groups."""
        count = self.count[groups]
        head = np.repeat(self.first[groups], count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return head + inner, head


def _mapper(bands: frozenset[int], num: int, den: int, frequent, width: int, buckets: Buckets):
    """Signatures of the texts as packed rows per bucket; ``frequent`` is the broadcast filter."""
    columns = ["bucket", "kind", "keys", "flags", "sids", "sizes", "counts"]

    def flush(groups: list, exact: list, sids: list, sizes: list, counts: list) -> pd.DataFrame:
        sids, sizes = np.array(sids, dtype=np.int64), np.array(sizes, dtype=np.int32)
        group = np.concatenate(groups)
        flags = np.where(np.concatenate(exact), _EXACT, 0).astype(np.uint8)
        doc = np.repeat(np.arange(len(sids), dtype=np.int32), counts)
        g = Grouped(group, doc, sizes[doc], flags)
        rows = []
        # Groups that are large already here: one entry goes on, the others are written now.
        large = (g.count > GROUP) & ((g.any & _EXACT) > 0)
        entry, head = g.members(np.flatnonzero(large))
        if len(entry):
            fits = _fits(g.size[entry], g.size[head], num, den) & (entry != head)
            a, b = _unique_pairs(sids[g.sid[head[fits]]], sids[g.sid[entry[fits]]])
            rows.append((int(g.sig[entry[0]] >> 32), _PAIR, a.tobytes(), b"", b.tobytes(), b"", b""))
            packed = g.sig[entry].tobytes(), b"", sids[g.sid[entry]].tobytes(), g.size[entry].tobytes(), b""
            rows.append((int(g.sig[entry[-1]] >> 32), _ENTRY, *packed))
        rest, _ = g.members(np.flatnonzero(~large))
        heads = g.first[large]
        keep = np.r_[rest, heads]
        group = np.r_[g.sig[keep], group[g.alone]]
        flags = np.r_[g.flags[rest], g.any[large] | _BIG, flags[g.alone]].astype(np.uint8)
        doc = np.r_[g.sid[keep], doc[g.alone]]
        del g
        bucket = group >> 32
        order = np.lexsort((doc, bucket))  # by document inside a bucket: only counts are needed to tell them apart
        edges = np.searchsorted(bucket[order], np.arange(buckets.n + 1))
        for k in np.flatnonzero(np.diff(edges)):
            part = order[edges[k] : edges[k + 1]]
            own, count = np.unique(doc[part], return_counts=True)
            packed = (group[part] & 0xFFFFFFFF).astype(np.uint32), flags[part], sids[own], sizes[own], count.astype(np.int32)
            rows.append((int(k), _SIG, *(x.tobytes() for x in packed)))
        return pd.DataFrame(rows, columns=columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        schemes = Schemes(bands, frequent.value, num, den)
        held, n, seen = ([], [], [], [], []), 0, set()
        for pdf in blocks(batches):
            for s in shingle_sets(pdf["text"].tolist(), width):
                if not len(s) or (sid := set_id(s)) in seen:
                    continue
                seen.add(sid)
                own = 0
                for band, _, sig, exact in schemes.signatures(s):
                    bucket, key = buckets.place(band, sig)
                    held[0].append((bucket << 32) | key)
                    held[1].append(exact)
                    own += len(sig)
                for part, value in zip(held[2:], (sid, len(s), own), strict=True):
                    part.append(value)
                n += own
                if n >= FLUSH:
                    yield flush(*held)
                    held, n, seen = ([], [], [], [], []), 0, set()
        if n:
            yield flush(*held)

    return run


def _reducer(num: int, den: int):
    def rows(kind: int, a: np.ndarray, b: np.ndarray, size: np.ndarray | None = None) -> pd.DataFrame:
        return pd.DataFrame({"kind": np.int32(kind), "a": a, "b": b, "size": np.zeros(len(a), dtype=np.int64) if size is None else size.astype(np.int64)})

    def unpack(r) -> tuple[np.ndarray, ...]:
        counts = np.frombuffer(r.counts, dtype=np.int32)
        key = np.frombuffer(r.keys, dtype=np.uint32).astype(np.int64)
        sid = np.repeat(np.frombuffer(r.sids, dtype=np.int64), counts)
        size = np.repeat(np.frombuffer(r.sizes, dtype=np.int32), counts)
        return (np.int64(r.bucket) << 32) | key, sid, size, np.frombuffer(r.flags, dtype=np.uint8)

    def matched(held: list[tuple]) -> Iterator[pd.DataFrame]:
        """The candidates of one bucket."""
        g = Grouped(*(np.concatenate(x) for x in zip(*held, strict=True)))
        usable = (g.count > 1) & ((g.any & _EXACT) > 0)
        big = usable & ((g.count > GROUP) | ((g.any & _BIG) > 0))
        found_a, found_b = [], []
        for n in range(2, GROUP + 1):
            first = g.first[usable & ~big & (g.count == n)]
            if len(first):
                i, j = np.triu_indices(n, 1)
                x, y = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
                fits = _fits(g.size[x], g.size[y], num, den)
                a, b = _unique_pairs(g.sid[x[fits]], g.sid[y[fits]])
                found_a.append(a)
                found_b.append(b)
        entry, head = g.members(np.flatnonzero(big))
        if len(entry):
            fits = _fits(g.size[entry], g.size[head], num, den) & (entry != head)
            found_a.append(g.sid[head[fits]])
            found_b.append(g.sid[entry[fits]])
            yield rows(_ENTRY, g.sig[entry], g.sid[entry], g.size[entry])
        if found_a:
            yield rows(_PAIR, *_unique_pairs(np.concatenate(found_a), np.concatenate(found_b)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, bucket = [], None  # rows come sorted by bucket
        for pdf in batches:
            for r in pdf.itertuples():
                if r.kind != _SIG:
                    a, b = np.frombuffer(r.keys, dtype=np.int64), np.frombuffer(r.sids, dtype=np.int64)
                    yield rows(r.kind, a, b, np.frombuffer(r.sizes, dtype=np.int32) if r.kind == _ENTRY else None)
                    continue
                if r.bucket != bucket and held:
                    yield from matched(held)
                    held = []
                bucket = r.bucket
                held.append(unpack(r))
        if held:
            yield from matched(held)
        trim()

    return run


def candidates(docs: DataFrame, schemes: Schemes, loads: np.ndarray, width: int = WIDTH) -> DataFrame:
    """Rows (kind, a, b, size): pairs of set ids, and (signature, set id, size) entries of large groups."""
    spark = docs.sparkSession
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(loads.sum()) // BUCKET_ENTRIES))
    frequent = spark.sparkContext.broadcast(schemes.frequent)  # BLOOM_BITS
    mapper = _mapper(schemes.deletion_bands, schemes.num, schemes.den, frequent, width, Buckets(loads, parts))
    blobs = docs.select("text").mapInPandas(mapper, _BLOB)
    dealt = blobs.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInPandas(_reducer(schemes.num, schemes.den), "kind int, a long, b long, size long")
    return stored(found, "candidates")


# ---- verification -----------------------------------------------------------------------------------------------


def _some_sketches(ids: DataFrame, sids: DataFrame) -> DataFrame:
    """(sid, n, sketch, tid) of the given set ids (and of few others), each once; tid is a text of that set."""
    shared = ids.sparkSession.sparkContext.broadcast(bloom(sids, "sid"))  # BLOOM_BITS

    @F.pandas_udf("boolean")
    def wanted(sid: pd.Series) -> pd.Series:
        return pd.Series(in_bloom(shared.value, sid.to_numpy(dtype=np.int64)))

    some = ids.where("sid IS NOT NULL").where(wanted("sid"))
    once = some.groupBy("sid").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.min("tid").alias("tid"))
    return stored(once, "sketches")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, text) of ``wanted`` (sid, tid); only texts that a Bloom filter lets pass are shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom(wanted, "tid"))  # BLOOM_BITS

    @F.pandas_udf("boolean")
    def asked(tid: pd.Series) -> pd.Series:
        return pd.Series(in_bloom(shared.value, tid.to_numpy(dtype=np.int64)))

    marked = docs.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("tid")).where(asked("tid"))
    once = marked.groupBy("tid").agg(F.first("text").alias("text"))
    return once.join(wanted, "tid").select("sid", "text")


def _with_both(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    left = sets.select(F.col("sid").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = sets.select(F.col("sid").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.select("a", "b").join(left, "a").join(right, "b")


def verify(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link: by their sketches first, which rule most others out, then by their whole sets."""

    @F.pandas_udf("boolean")
    def plausible(n: pd.Series, m: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(v), dtype=np.uint64).reshape(len(v), -1) for v in (x, y))
        apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
        return pd.Series(apart * (den + num) <= (n + m).to_numpy() * (den - num))

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for part in blocks(iter([pd.DataFrame({"text": x, "other": y})])):
            sets = zip(shingle_sets(part["text"].tolist(), width), shingle_sets(part["other"].tolist(), width), strict=True)
            for s, t in sets:
                both = np.sort(np.concatenate([s, t]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                out.append(den * common >= num * (len(both) - common))
        return pd.Series(out, dtype=bool)

    likely = _with_both(pairs, sketches, ["n", "sketch"]).where(plausible("n_a", "n_b", "sketch_a", "sketch_b"))
    likely = stored(likely.select("a", "b"), "likely")
    named = likely.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    texts = stored(_texts(docs, named.join(sketches.select("sid", "tid"), "sid")), "texts")
    return _with_both(likely, texts, ["text"]).where(linked("text_a", "text_b")).select("a", "b")


def _named(entries: DataFrame, comp: DataFrame) -> DataFrame:
    named = entries.join(comp, entries["sid"] == comp["node"], "left")
    return named.select("sig", "sid", "size", F.coalesce("component", "sid").alias("comp"))


def _open_groups(named: DataFrame) -> DataFrame:
    """(sig, n) of the large groups of several components; of groups with equal members, one."""
    groups = named.groupBy("sig").agg(
        F.count("*").alias("n"),
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
        F.bit_xor("sid").alias("x"),
        F.bit_xor(F.xxhash64("sid")).alias("y"),
    )
    return groups.where("lo <> hi").groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "n")


def _tile_pairs(named: DataFrame, open_: DataFrame, sketches: DataFrame, num: int, den: int, nearest: bool) -> DataFrame:
    """Pairs of different components of each open group that their sketches don't rule out.

    All of them, or with ``nearest`` for each member outside the tile's largest
    component only the one that looks most alike. Every group is cut into tiles
    of about TILE x TILE members, so a task holds few members whatever the
    group's size.
    """
    tiles = open_.select("sig", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    members = named.join(tiles, "sig").join(sketches.select("sid", "sketch"), "sid")
    tiled = members.withColumn("t", F.pmod(F.xxhash64("sid"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.withColumn("i", F.least("t", "o")).withColumn("j", F.greatest("t", "o"))

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "sid"], kind="stable")
        one_tile = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        sid, size, comp, t = (pdf[c].to_numpy() for c in ("sid", "size", "comp", "t"))
        sketch = np.stack([np.frombuffer(b, dtype=np.uint64) for b in pdf["sketch"]])
        stop = np.searchsorted(size, size * den // num, side="right")  # partners: the larger ones that fit
        least, partner = np.full(len(sid), np.iinfo(np.int64).max), np.zeros(len(sid), dtype=np.int64)
        a, b = [sid[:0]], [sid[:0]]
        for x in range(len(sid)):
            y = np.arange(x + 1, stop[x])
            y = y[(comp[y] != comp[x]) & (one_tile | (t[y] != t[x]))]
            apart = np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1, dtype=np.int64)
            likely = apart * (den + num) <= (size[x] + size[y]) * (den - num)
            y, apart = y[likely], apart[likely]
            if not len(y):
                continue
            if not nearest:
                a.append(np.full(len(y), sid[x]))
                b.append(sid[y])
                continue
            k = int(apart.argmin())
            if apart[k] < least[x]:
                least[x], partner[x] = apart[k], sid[y[k]]
            closer = apart < least[y]
            least[y[closer]], partner[y[closer]] = apart[closer], sid[x]
        if nearest:
            names, count = np.unique(comp, return_counts=True)
            asks = (least < np.iinfo(np.int64).max) & (comp != names[count.argmax()])
            a, b = [sid[asks]], [partner[asks]]
        lo, hi = _unique_pairs(np.concatenate(a), np.concatenate(b))
        return pd.DataFrame({"a": lo, "b": hi})

    return tiled.groupBy("sig", "i", "j").applyInPandas(pairs, "a long, b long").distinct()


@dataclass
class _Joined:
    """The join up to the links within groups of at most GROUP sets."""

    docs: DataFrame
    ids: DataFrame  # per row: doc_id, tid, n_shingles, sid, sketch
    pairs: DataFrame  # verified pairs
    entries: DataFrame  # members of large groups
    sketches: DataFrame
    links: DataFrame


def _joined(docs: DataFrame, width: int, num: int, den: int) -> _Joined:
    docs = docs.select("doc_id", "text")
    ids = docs.select("doc_id", F.xxhash64("text").alias("tid"), set_ids(F.col("text"), width, sketches=True).alias("s"))
    ids = stored(ids.select("doc_id", "tid", "s.n_shingles", "s.sid", "s.sketch"), "set_ids")
    schemes = plan_schemes(docs, width, num, den)
    found = candidates(docs, schemes, _band_loads(ids, num, den), width)
    pairs = stored(found.where(F.col("kind") == _PAIR).select("a", "b").distinct(), "pairs")
    entries = found.where(F.col("kind") == _ENTRY).select(F.col("a").alias("sig"), F.col("b").alias("sid"), "size").distinct()
    entries = stored(entries, "entries")
    named = pairs.select(F.explode(F.array("a", "b")).alias("sid")).unionByName(entries.select("sid"))
    sketches = _some_sketches(ids, named.distinct())
    links = stored(verify(pairs, sketches, docs, width, num, den), "links")
    return _Joined(docs, ids, pairs, entries, sketches, links)


def _all_links(joined: _Joined, width: int, num: int, den: int) -> DataFrame:
    # Every member counts as a component of its own: all pairs of a group take part, tile by tile.
    named = joined.entries.withColumn("comp", F.col("sid"))
    tiles = _tile_pairs(named, stored(_open_groups(named), "open"), joined.sketches, num, den, nearest=False)
    cross = stored(tiles.join(joined.pairs, ["a", "b"], "left_anti"), "pairs")
    more = verify(cross, joined.sketches, joined.docs, width, num, den)
    return stored(joined.links.unionByName(more), "links")


def jaccard_links(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN) -> tuple[DataFrame, DataFrame]:
    """All links of ``docs`` (doc_id, text): the linked pairs of different sets, and the members of the sets.

    The pairs are (a, b), a < b set ids, each once; equal sets have one id. Members are one row per row of ``docs``:
    doc_id, n_shingles, set_id (null where the set is empty), n_equal (other rows of the same set) and n_links (rows of
    other sets that link).
    """
    joined = _joined(docs, width, num, den)
    links = _all_links(joined, width, num, den)
    sizes = stored(joined.ids.where("sid IS NOT NULL").groupBy("sid").agg(F.count("*").alias("rows")), "sizes")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(sizes, both["b"] == sizes["sid"]).groupBy("a").agg(F.sum("rows").alias("n_links"))
    per_set = stored(sizes.join(counts, sizes["sid"] == counts["a"], "left").select("sid", "rows", "n_links"), "counts")
    members = joined.ids.select("doc_id", "n_shingles", "sid").join(per_set, "sid", "left")
    return links, members.select(
        "doc_id",
        "n_shingles",
        F.col("sid").alias("set_id"),
        F.coalesce(F.col("rows") - 1, F.lit(0)).cast("bigint").alias("n_equal"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def jaccard_components(docs: DataFrame, width: int = WIDTH, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, set_id, component (a set id) and component_id.

    component is null, and component_id the row's own id, where the set is empty. Only as many pairs of large groups
    are verified as the components need; ``jaccard_links`` has all.
    """
    joined = _joined(docs, width, num, den)
    docs, ids, pairs, entries, sketches = joined.docs, joined.ids, joined.pairs, joined.entries, joined.sketches
    comp = stored(components(joined.links), "components")
    for nearest in (True, False):
        named = _named(entries, comp)
        open_ = stored(_open_groups(named), "open")
        if open_.isEmpty():
            break
        cross = stored(_tile_pairs(named, open_, sketches, num, den, nearest).join(pairs, ["a", "b"], "left_anti"), "pairs")
        more = stored(verify(cross, sketches, docs, width, num, den), "links")
        if not more.isEmpty():
            known = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
            comp = stored(components(known.unionByName(more)), "components")
        pairs = pairs.unionByName(cross)
    named = ids.join(comp, ids["sid"] == comp["node"], "left").select(
        "doc_id", "n_shingles", F.col("sid").alias("set_id"), F.coalesce("component", "sid").alias("component")
    )
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return named.join(least, "component", "left").select("doc_id", "n_shingles", "set_id", "component", own.alias("component_id"))
