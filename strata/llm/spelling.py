"""Spelling variants: words one edit apart, by composing acceptors with a one-edit transducer.

The vocabulary's minimised acceptor A, a transducer E that copies its input but
for exactly one replaced, inserted or deleted code point, and A again: what
A . E . A accepts are the pairs of words one edit apart. A state of the
composition is (state of A, edits so far, state of A); before the edit both
sides have read the same and are one state, after it both must read the same
to the end. The edit stands at the first place where the two words differ, so
every pair is accepted once.

Partitions of the initial state. A pair whose words first differ at position i
shares all before i and all behind the edit. So pairs are dealt by the length N
of the longer word and a range [lo, hi) of i: both words lie in the partition
(N, lo, hi, prefix before lo, suffix from hi on), whose initial state is the
acceptor's state after that prefix, and whose acceptor needs the middles only.
The two halves of each length are the first ranges; a partition of more than
PART_WORDS words is cut into the two halves of its range, down to one position,
where no more words meet than there are letters. Many partitions (BUCKET_ROWS
rows on average) go to a task, as one acceptor with as many initial states.

Inside a task the acceptor is minimised level by level (all middles of a class
have one length, or one less for the shorter words), transitions carry the
number of words that they skip, so that a path yields its word's number, and
the composition advances level by level for all pairs of states at once. Pairs
of equal states accept everything that is left, as one range. Pairs are added
up per word before they leave the task.

Null or empty texts have no words; a null id counts as the empty text. Texts
are read whole, and words have any length. Repeated rows count again. An empty
table gives no words. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mix, stored, trim

#: Letters of a word: ASCII letters and U+00C0 to U+00FF.
_GAPS = "[^A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run loses a code point if this divides its hash.
NOISE = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form has at least this many times the word's occurrences.
FORM_RATIO = 5
PART_WORDS = 1 << 15
BUCKET_ROWS = 1 << 16
#: Accepted pairs that are written out at once.
PAIRS = 1 << 21


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text: str = "text", noise: int = NOISE) -> DataFrame:
    """Words of at least LEAST_LENGTH code points with LEAST_COUNT occurrences: word, n; stored.

    ``noise`` plants misspellings: a run loses one code point if the crc32 of
    "<id>:<run>" is a multiple of it.
    """
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id")
    runs = docs.select(name, F.explode(F.split(F.col(text), _GAPS)).alias("run")).where(F.length("run") >= LEAST_LENGTH)
    low = F.lower("run")  # most runs are lower case already
    runs = runs.select("id", F.when(low == F.col("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    cut = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % noise == 0, less).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted.where(F.col("n") >= LEAST_COUNT), "vocabulary")


def _ranges(words: DataFrame) -> DataFrame:
    """Each word for pairs of its own length and, as the shorter one, of one more: both halves."""
    own, more = F.length("word"), F.length("word") + 1

    def half(size, shorter, upper):
        mid = F.floor(size / 2).cast("int")
        lo, hi = (mid, size) if upper else (F.lit(0), mid)
        return F.struct(size.alias("size"), lo.alias("lo"), hi.alias("hi"), F.lit(shorter).alias("shorter"))

    each = F.array(*[half(s, k, u) for s, k in ((own, False), (more, True)) for u in (False, True)])
    return words.select("word", "n", F.explode(each).alias("r")).select("word", "n", "r.*")


def _partition(df: DataFrame) -> DataFrame:
    """Add the shared prefix and suffix that name each row's partition."""
    behind = F.col("hi") - F.col("shorter").cast("int")
    return df.withColumns(
        {
            "prefix": F.substring("word", F.lit(1), F.col("lo")),
            "suffix": F.substring("word", behind + 1, F.length("word")),
        }
    )


_PART = ["size", "lo", "hi", "prefix", "suffix"]


def partitions(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """word, n, size, lo, hi, shorter, prefix, suffix: the words of every partition, large ones cut."""
    rows = _partition(_ranges(words))
    while True:
        sizes = rows.groupBy(*_PART).count()
        large = sizes.where((F.col("count") > part_words) & (F.col("hi") - F.col("lo") > 1)).select(*_PART)
        if large.isEmpty():
            return rows
        large = stored(large, "large-partitions")
        rest = rows.join(large, _PART, "left_anti")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        two = F.explode(F.array(F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("hi").alias("b"))))
        cut = rows.join(large, _PART, "left_semi").select("word", "n", "size", "shorter", two.alias("r"))
        cut = _partition(cut.select("word", "n", "size", F.col("r.a").alias("lo"), F.col("r.b").alias("hi"), "shorter"))
        rows = stored(rest.unionByName(cut), "partitions")


# --- inside a task: acceptors of middles of one length --------------------------


@dataclass
class _Trie:
    """Sorted rows of codes; the prefix tree's nodes at depth t are numbered in order."""

    codes: np.ndarray  # rows x depth; column 0 is the initial state
    first: list[np.ndarray]  # per depth: first row of each node
    parent: list[np.ndarray]  # per depth: parent of each node

    @classmethod
    def of(cls, codes: np.ndarray) -> _Trie:
        rows, depth = codes.shape
        new = np.ones((rows, depth), dtype=bool)
        if rows > 1:
            new[1:] = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
        first, parent = [np.zeros(min(rows, 1), dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        above = np.zeros(rows, dtype=np.int64)
        for t in range(depth):
            starts = np.flatnonzero(new[:, t])
            first.append(starts)
            parent.append(above[starts])
            above = np.cumsum(new[:, t]) - 1
        return cls(codes, first, parent)


@dataclass
class _Level:
    """Minimal states with a given number of symbols to go; transitions in order of state and label."""

    start: np.ndarray  # first transition of each state, one more entry than states
    label: np.ndarray
    child: np.ndarray
    skip: np.ndarray  # words before this transition
    count: np.ndarray  # words that each state accepts

    def key(self) -> np.ndarray:
        state = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        return state << 32 | self.label


def _expand(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entry, and start + 0, 1, ..., size - 1 for each entry."""
    of = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    return of, start[of] + within


def _classes(size: np.ndarray, label: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes with equal transitions: class of each node, and one node of each class."""
    start = np.cumsum(size) - size
    value = mix(label.astype(np.uint64) << np.uint64(32) | child.astype(np.uint64))
    total = np.r_[np.uint64(0), np.cumsum(value, dtype=np.uint64)]
    hashed = mix(total[start + size] - total[start]) + size.astype(np.uint64)
    _, pick, cls = np.unique(hashed, return_index=True, return_inverse=True)
    of, at = _expand(start[pick[cls]], size)  # each node's transitions beside those of its class
    same = np.array_equal(size, size[pick[cls]]) and np.array_equal(label[at], label) and np.array_equal(child[at], child)
    if not same:  # two different nodes with one hash: compare them in full
        seen: dict[bytes, int] = {}
        pair = np.stack([label, child], axis=1)
        cls = np.array([seen.setdefault(pair[s : s + k].tobytes(), len(seen)) for s, k in zip(start, size, strict=True)])
        _, pick = np.unique(cls, return_index=True)
    return cls, pick


def _minimise(tries: list[_Trie]) -> tuple[list[_Level], list[list[np.ndarray]]]:
    """States by symbols to go, shared by all tries, and per trie the state of each node by depth.

    Depth 0 (before the initial state is chosen) has no state.
    """
    deepest = max(t.codes.shape[1] for t in tries)
    levels = [_Level(np.zeros(2, np.int64), *(np.zeros(0, np.int64) for _ in range(3)), np.ones(1, np.int64))]
    states = [[np.zeros(0, np.int64)] * t.codes.shape[1] + [np.zeros(len(t.codes), np.int64)] for t in tries]
    for height in range(1, deepest):
        size, label, child, owner = [], [], [], []
        for k, t in enumerate(tries):
            depth = t.codes.shape[1] - height
            if depth < 1:
                continue
            size.append(np.bincount(t.parent[depth + 1], minlength=len(t.first[depth])))
            label.append(t.codes[t.first[depth + 1], depth].astype(np.int64))
            child.append(states[k][depth + 1])
            owner.append((k, depth))
        size, label, child = (np.concatenate(x) for x in (size, label, child))
        cls, pick = _classes(size, label, child)
        at = 0
        for k, depth in owner:
            nodes = len(tries[k].first[depth])
            states[k][depth] = cls[at : at + nodes]
            at += nodes
        start = np.cumsum(size) - size
        _, chosen = _expand(start[pick], size[pick])
        words = levels[-1].count[child[chosen]]
        begin = np.r_[0, np.cumsum(size[pick])]
        before = np.r_[0, np.cumsum(words)]
        skip = before[:-1] - np.repeat(before[begin[:-1]], size[pick])
        levels.append(_Level(begin, label[chosen], child[chosen], skip, before[begin[1:]] - before[begin[:-1]]))
    return levels, states


def _beside(a: _Trie, b: _Trie) -> list[np.ndarray]:
    """Per depth, the node of ``a`` with the same prefix as each node of ``b``, or -1."""
    found = [np.zeros(len(b.first[0]), dtype=np.int64) if len(a.first[0]) else np.full(len(b.first[0]), -1)]
    for t in range(min(a.codes.shape[1], b.codes.shape[1])):
        up = found[-1][b.parent[t + 1]]
        have = a.parent[t + 1] << 32 | a.codes[a.first[t + 1], t]
        want = np.where(up >= 0, up << 32 | b.codes[b.first[t + 1], t], -1)
        at = np.minimum(np.searchsorted(have, want), max(len(have) - 1, 0))
        found.append(np.where(have[at] == want, at, -1) if len(have) else np.full(len(want), -1))
    return found


def _composed(levels: list[_Level], edits: dict[int, tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Ranges (origin, left offset, right offset, length) accepted after the edit.

    ``edits``: by symbols to go, the states that edits lead to: origin, left
    state, right state, left and right offset.
    """
    front = tuple(np.zeros(0, np.int64) for _ in range(5))
    for height in range(max(edits, default=-1), -1, -1):
        if height in edits:
            front = tuple(np.concatenate(x) for x in zip(front, edits[height], strict=True))
        origin, p, q, off_p, off_q = front
        same = p == q  # they accept the same, whatever is left
        yield origin[same], off_p[same], off_q[same], levels[height].count[p[same]]
        front = _step(levels, height, *(x[~same] for x in front))


def _step(levels: list[_Level], height: int, origin, p, q, off_p, off_q, forbidden=None) -> tuple[np.ndarray, ...]:
    """Both sides read one equal symbol (not ``forbidden``)."""
    if height == 0 or not len(p):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    level = levels[height]
    key = level.key()
    of, t = _expand(level.start[p], np.diff(level.start)[p])
    want = q[of] << 32 | level.label[t]
    at = np.minimum(np.searchsorted(key, want), len(key) - 1)
    ok = key[at] == want
    if forbidden is not None:
        ok &= level.label[t] != forbidden[of]
    of, t, at = of[ok], t[ok], at[ok]
    return origin[of], level.child[t], level.child[at], off_p[of] + level.skip[t], off_q[of] + level.skip[at]


def _paired(origin, left, right, size, starts: np.ndarray, of_origin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers of all pairs: each range once for every place (left, right base) of its origin."""
    begin = np.searchsorted(of_origin, np.arange(int(origin.max(initial=-1)) + 2))
    places = begin[origin + 1] - begin[origin]
    cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(places * size) // PAIRS)) + 1, len(origin)]
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        of, place = _expand(begin[origin[lo:hi]], places[lo:hi])
        of += lo
        within, step = _expand(np.zeros(len(of), np.int64), size[of])
        yield starts[place[within], 0] + left[of[within]] + step, starts[place[within], 1] + right[of[within]] + step


def accepted(a_codes: np.ndarray, b_codes: np.ndarray, positions: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Pairs accepted by the composition, as row numbers, in blocks.

    ``a_codes``: sorted distinct rows, column 0 the initial state, then the
    middles of the longer words; ``b_codes``: the same with one column less for
    the shorter ones. Edits at the first ``positions`` symbols. Blocks are
    ("replace", rows of a, rows of a) or ("delete", rows of a, rows of b).
    """
    a, b = _Trie.of(a_codes), _Trie.of(b_codes)
    levels, (in_a, in_b) = _minimise([a, b])
    depth = a_codes.shape[1]
    edits, places = {}, []
    for t in range(1, positions + 1):  # t symbols read, the initial state included
        height = depth - t
        cls, nodes = in_a[t], a.first[t]
        kinds, of = np.unique(cls, return_inverse=True)
        level = levels[height]
        size = np.diff(level.start)[kinds]
        one, left = _expand(level.start[kinds], size)
        upto = level.start[kinds][one] + size[one]
        pair, right = _expand(left + 1, upto - left - 1)
        left = left[pair]
        base = sum(n for n, _, _ in places)
        origin = one[pair] + base
        edits[height - 1] = (origin, level.child[left], level.child[right], level.skip[left], level.skip[right])
        places.append((len(kinds), of + base, np.stack([nodes, nodes], axis=1)))
    yield from _blocks("replace", levels, edits, places)

    beside = _beside(a, b)
    edits, places = {}, []
    for t in range(1, positions + 1):
        height = depth - t
        if t >= len(beside):
            break
        mine = np.flatnonzero(beside[t] >= 0)
        of_a, of_b = in_a[t][beside[t][mine]], in_b[t][mine]
        both, of = np.unique(of_a << 32 | of_b, return_inverse=True)
        p, q = both >> 32, both & 0xFFFFFFFF
        level = levels[height]
        one, gone = _expand(level.start[p], np.diff(level.start)[p])  # the code point that the shorter word lacks
        base = sum(n for n, _, _ in places)
        state = (one + base, level.child[gone], q[one], level.skip[gone], np.zeros(len(one), np.int64))
        if height == 1:  # nothing is left to read
            into = 0
        else:
            state, into = _step(levels, height - 1, *state, forbidden=level.label[gone]), height - 2
        edits[into] = tuple(np.concatenate(x) for x in zip(edits[into], state, strict=True)) if into in edits else state
        places.append((len(both), of + base, np.stack([a.first[t][beside[t][mine]], b.first[t][mine]], axis=1)))
    yield from _blocks("delete", levels, edits, places)


def _blocks(kind, levels, edits, places):
    of_origin = np.concatenate([x[1] for x in places]) if places else np.zeros(0, np.int64)
    starts = np.concatenate([x[2] for x in places]) if places else np.zeros((0, 2), np.int64)
    order = np.argsort(of_origin, kind="stable")
    of_origin, starts = of_origin[order], starts[order]
    for ranges in _composed(levels, edits):
        if len(ranges[0]):
            for left, right in _paired(*ranges, starts, of_origin):
                yield kind, left, right


def _codes(middles: list[str], state: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows (initial state, code points) and the order that sorts them."""
    text = np.frombuffer("".join(middles).encode("utf-32-le", "surrogatepass"), dtype=np.int32).reshape(len(middles), width)
    codes = np.concatenate([state[:, None].astype(np.int32), text], axis=1)
    order = np.lexsort(codes.T[::-1]) if len(codes) else np.zeros(0, np.int64)
    return codes[order], order


def _near(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per word with pairs in these partitions: how many, and its best near word (largest n, then smallest)."""
    out = []
    span = (pdf["hi"] - pdf["lo"]).to_numpy()
    more = (pdf["hi"] < pdf["size"]).to_numpy()  # one symbol of the suffix tells where a deleted run ends
    for (positions, tail), part in pdf.groupby([span, more], sort=False):
        part = part.reset_index(drop=True)
        named = part["size"].astype(str) + ":" + part["lo"].astype(str) + ":" + part["prefix"] + "\0" + part["suffix"]
        state = pd.factorize(named)[0]
        words, n = part["word"].to_numpy(), part["n"].to_numpy()
        rank = np.empty(len(part), dtype=np.int64)
        by_rank = np.array(sorted(range(len(part)), key=lambda i: (-n[i], words[i])))
        rank[by_rank] = np.arange(len(part))
        width = positions + int(tail)
        side = []
        for shorter in (False, True):
            rows = np.flatnonzero(part["shorter"].to_numpy() == shorter)
            middles = [words[i][lo : lo + width - shorter] for i, lo in zip(rows, part["lo"].to_numpy()[rows], strict=True)]
            codes, order = _codes(middles, state[rows], width - shorter)
            side.append((codes, rows[order]))
        (a, a_rows), (b, b_rows) = side
        if not len(a):
            continue
        near, best = np.zeros(len(part), np.int64), np.full(len(part), len(part), np.int64)
        for kind, left, right in accepted(a, b, positions):
            left, right = a_rows[left], (a_rows if kind == "replace" else b_rows)[right]
            for x, y in ((left, right), (right, left)):
                near += np.bincount(x, minlength=len(part))
                np.minimum.at(best, x, rank[y])
        hit = np.flatnonzero(near)
        found = by_rank[best[hit]]
        out.append((words[hit], near[hit], n[found], words[found]))
    trim()
    none = [np.zeros(0, kind) for kind in (object, np.int64, np.int64, object)]
    columns = [np.concatenate(x) for x in zip(none, *out, strict=True)]
    return pd.DataFrame(dict(zip(("word", "n_near", "best_n", "best"), columns, strict=True)))


def neighbours(words: DataFrame, part_words: int = PART_WORDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per word of ``words`` (word, n; distinct): n, n_near, best (near word of largest n, ties: smallest), best_n; stored."""
    rows = partitions(words, part_words)
    buckets = max(1, -(-rows.count() // bucket_rows))
    bucket = F.pmod(F.xxhash64(*_PART), F.lit(buckets)).cast("int")
    dealt = rows.withColumn("bucket", bucket).groupBy("bucket")
    parts = dealt.applyInPandas(_near, "word string, n_near long, best_n long, best string")
    none = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<m:bigint,best:string>").alias("b"))
    some = parts.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("m"), "best").alias("b"))
    found = none.unionByName(some).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("b").alias("b"))
    return stored(found.select("word", "n", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n")), "near-words")


def forms(near: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n: the form is the best near word if it is ``ratio`` times as frequent.

    Roots by pointer jumping: counts grow along forms by ``ratio``, so a few
    rounds reach the last one.
    """
    enough = F.col("best_n") >= ratio * F.col("n")
    named = near.select("word", "n", "n_near", F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n"))
    links = stored(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    full = named.join(links, "word", "left")
    return full.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
