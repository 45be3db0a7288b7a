"""Secret scan: base patterns, and formats learned by grammar inference.

Base spans (code points, end exclusive) are the leftmost non-overlapping
matches of three fixed patterns, per kind, of at least the given length.

The formats are learned from the labelled credentials that the base patterns
find: per kind, a prefix tree of a bounded sample of distinct values (characters
mapped to classes) is generalised by merging statistically compatible states
(the Hoeffding test on end and symbol frequencies, recursively, in red-blue
order) into a probabilistic automaton. A background automaton is inferred from
ordinary tokens in the same way. Candidates are the maximal runs of the
characters that credentials are made of, and within each run what lies between
its marks ``. / =``: one part or several neighbouring ones, up to as many as a
learned credential has; ``:`` and all other characters end a run. A candidate's
score is the log2 likelihood of the best format against the background per
character. It is found when it touches no base span, its score is at least
``margin``, and its own likelihood under that format is at most ``slack`` bits
per character below that of the least likely twentieth of the credentials.
(Ordinary tokens may hold unmarked credentials, so they set no threshold
themselves.) Of overlapping finds that with the most bits in all stays; finds
are added as kind ``format``.

Very long texts and runs are scanned whole: a run's symbols are read once from
each of its parts on, and overlaps are found by bisection.

Null texts count as empty. Empty tables, or tables without credentials, give
base spans only. Rows are independent, so repeated rows repeat their result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import first_by_hash

#: The base patterns in their listed order, the group that is measured and its least length.
BASE = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", r"([0-9a-f]{16,})", 1, 16),  # a shorter run never passes, and runs don't overlap
)
FORMAT = "format"
_RULES = [(kind, re.compile(p), group, least) for kind, p, group, least in BASE]
_RANK = {kind: k for k, (kind, *_) in enumerate(BASE)} | {FORMAT: len(BASE)}
#: Runs that hold candidates and background tokens, the marks between their parts, and a candidate's least length.
_LEAST = 12
_TOKEN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{_LEAST},}}")
_PART = re.compile(r"[^./=]+(?:=+(?=[./]|$))?")  # padding belongs to its part


def pieces(run: str, most: int) -> list[tuple[int, int]]:
    """(start, end) of the run less dots at its ends, and of one to ``most`` neighbouring parts, of at least _LEAST characters."""
    parts = [m.span() for m in _PART.finditer(run)]
    out = {(len(run) - len(run.lstrip(".")), len(run.rstrip(".")))}
    for i, (start, _) in enumerate(parts):
        out.update((start, end) for _, end in parts[i : i + most])
    return sorted((a, b) for a, b in out if b - a >= _LEAST)


class Covered:
    """Disjoint spans by start, for overlap tests by bisection. Spans that overlap at first become one."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] < end

    def add(self, start: int, end: int) -> None:
        """A span that meets none."""
        at = bisect_right(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def base_spans(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind as listed."""
    out = []
    for kind, rule, group, least in _RULES:
        for m in rule.finditer(text or ""):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end(), m.group(group)))
    return sorted(out, key=lambda s: (s[1], _RANK[s[0]]))


def symbols(value: str) -> str:
    """Character classes: hex letters, other letters, digits, each punctuation mark itself."""
    return "".join(
        "d" if c.isdigit() else "h" if c in "abcdef" else "l" if c.islower() else "H" if c in "ABCDEF" else "U" if c.isupper() else c
        for c in value
    )


@dataclass
class Automaton:
    """A probabilistic automaton: per state its log2 symbol and end likelihoods."""

    step: list[dict[str, tuple[int, float]]]
    end: list[float]
    unseen: list[float]

    def read(self, word: str, state: int = 0, total: float = 0.0) -> tuple[int, float]:
        """State and log2 likelihood after more symbols; unseen symbols have a smoothed share."""
        for s in word:
            nxt = self.step[state].get(s)
            if nxt is None:
                total += self.unseen[state]
                state = 0
            else:
                state, p = nxt
                total += p
        return state, total

    def ended(self, state: int, total: float, length: int) -> float:
        """log2 likelihood per symbol of a word of this length that ends here, the end included."""
        return (total + self.end[state]) / (length + 1)

    def likelihood(self, word: str) -> float:
        return self.ended(*self.read(word), len(word))


#: Symbols that an automaton can tell apart at most, for the smoothed share of unseen ones.
_ALPHABET = 12


@dataclass
class _Node:
    ends: int = 0
    passed: int = 0
    to: dict[str, int] = field(default_factory=dict)


def infer(words: list[str], alpha: float = 0.05) -> Automaton:
    """Red-blue state merging of the words' prefix tree under the Hoeffding test at level alpha."""
    nodes = [_Node()]
    for word in words:
        at = 0
        nodes[0].passed += 1
        for s in word:
            nxt = nodes[at].to.get(s)
            if nxt is None:
                nxt = nodes[at].to[s] = len(nodes)
                nodes.append(_Node())
            at = nxt
            nodes[at].passed += 1
        nodes[at].ends += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def flow(n: int, s: str) -> int:
        return nodes[nodes[n].to[s]].passed if s in nodes[n].to else 0

    # How often each edge was taken; kept apart from the target's count, which merging raises.
    taken = [{s: flow(n, s) for s in node.to} for n, node in enumerate(nodes)]

    def differ(x: int, n: int, y: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(x / n - y / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(red: int, blue: int) -> bool:
        stack = [(red, blue)]
        while stack:  # the blue side is a tree, so this ends
            a, b = stack.pop()
            n, m = nodes[a].passed, nodes[b].passed
            if differ(nodes[a].ends, n, nodes[b].ends, m):
                return False
            for s in nodes[a].to.keys() | nodes[b].to.keys():
                if differ(taken[a].get(s, 0), n, taken[b].get(s, 0), m):
                    return False
                if s in nodes[a].to and s in nodes[b].to:
                    stack.append((nodes[a].to[s], nodes[b].to[s]))
        return True

    def fold(red: int, blue: int) -> None:
        stack = [(red, blue)]
        while stack:
            a, b = stack.pop()
            nodes[a].ends += nodes[b].ends
            nodes[a].passed += nodes[b].passed
            for s, t in nodes[b].to.items():
                if s in nodes[a].to:
                    taken[a][s] += taken[b][s]
                    stack.append((nodes[a].to[s], t))
                else:
                    nodes[a].to[s] = t
                    taken[a][s] = taken[b][s]

    red = [0]
    while True:
        inside = set(red)
        blue = [(nodes[r].to[s], r, s) for r in red for s in sorted(nodes[r].to) if nodes[r].to[s] not in inside]
        if not blue:
            break
        b, parent, s = max(blue, key=lambda x: (nodes[x[0]].passed, -x[0]))
        into = next((r for r in red if compatible(r, b)), None)
        if into is None:
            red.append(b)
        else:
            nodes[parent].to[s] = into
            fold(into, b)
    index = {r: k for k, r in enumerate(red)}
    steps, ends, unseen = [], [], []
    for r in red:
        total = nodes[r].ends + sum(taken[r].values()) + 0.1 * (_ALPHABET + 1)
        steps.append({s: (index[t], math.log2((taken[r][s] + 0.1) / total)) for s, t in nodes[r].to.items()})
        ends.append(math.log2((nodes[r].ends + 0.1) / total))
        unseen.append(math.log2(0.1 / total))
    return Automaton(steps, ends, unseen)


@dataclass
class Formats:
    kinds: dict[str, tuple[Automaton, float]]  # automaton, least likelihood of its own credentials
    background: Automaton | None
    least_score: float
    most_parts: int = 1  # parts of a credential between marks

    def score(self, token: str) -> float | None:
        """Score of a candidate that some format explains well enough, else None."""
        return next((s for _, s in self.scores(symbols(token), 0, [len(token)])), None)

    def scores(self, word: str, start: int, ends: Iterable[int]) -> Iterator[tuple[int, float | None]]:
        """(end, score) of the candidates from ``start`` to each of the rising ``ends``: one reading of the symbols for all."""
        if not self.kinds or self.background is None:
            return
        automata = [self.background, *(a for a, _ in self.kinds.values())]
        least = [t for _, t in self.kinds.values()]
        at, read = start, [(0, 0.0)] * len(automata)
        for end in ends:
            read = [a.read(word[at:end], *r) for a, r in zip(automata, read, strict=True)]
            at = end
            base, *own = (a.ended(*r, end - start) for a, r in zip(automata, read, strict=True))
            yield end, max((p - base for p, t in zip(own, least, strict=True) if p >= t), default=None)


def _training(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = set()
        for text in pdf["text"]:
            spans = base_spans(text)
            rows.update((kind, value) for kind, _, _, value in spans)
            covered = Covered((s, e) for _, s, e, _ in spans)
            for m in _TOKEN.finditer(text or ""):
                for a, b in pieces(m.group(), 1):
                    start, end = m.start() + a, m.start() + b
                    if not covered.meets(start, end):
                        rows.add(("", text[start:end]))
        yield pd.DataFrame(sorted(rows), columns=["kind", "value"])


def fit(docs: DataFrame, sample: int = 2000, background: int = 4000, margin: float = 1.0, slack: float = 0.75) -> Formats:
    """Infer the formats from all texts' credentials.

    Bounded sample: per kind the ``sample`` (for ordinary tokens ``background``)
    distinct values that come first by hash.
    """
    values = docs.select("text").where("text IS NOT NULL").mapInPandas(_training, "kind string, value string")
    limit = F.when(F.col("kind") == "", background).otherwise(sample)
    distinct = values.withColumn("h", F.xxhash64("value")).groupBy("kind", "h", "value").agg(F.lit(1).alias("one"))
    first = first_by_hash(distinct, "kind", ["h", "value"], max(sample, background)).where(F.col("r") <= limit)
    by = defaultdict(list)
    for r in first.select("kind", "value").collect():
        by[r["kind"]].append(r["value"])
    plain = infer(sorted(map(symbols, by[""]))) if by.get("") else infer(["l" * 12])
    kinds = {}
    for kind, *_ in BASE:
        if by.get(kind):
            words = sorted(map(symbols, by[kind]))
            automaton = infer(words)
            own = sorted(automaton.likelihood(w) for w in words)
            kinds[kind] = (automaton, own[len(own) // 20] - slack)
    most = max((len(_PART.findall(v)) for kind, *_ in BASE for v in by.get(kind, [])), default=1)
    return Formats(kinds, plain, margin, max(most, 1))


def candidates(run: str, offset: int, formats: Formats, covered: Covered) -> Iterator[tuple[int, int, float | None]]:
    """(start, end, score) in the text of the run's ``pieces`` that meet no covered span.

    From every part on, the symbols are read once and scored at every part's
    end, up to the most parts of a learned credential or the first covered span.
    """
    word, parts, seen = symbols(run), [m.span() for m in _PART.finditer(run)], set()
    for i, (start, _) in enumerate(parts):
        def ends(i: int = i, start: int = start) -> Iterator[int]:
            for _, end in parts[i : i + formats.most_parts]:
                if covered.meets(offset + start, offset + end):
                    return
                yield end

        for end, score in formats.scores(word, start, ends()):
            seen.add((start, end))
            if end - start >= _LEAST:
                yield offset + start, offset + end, score
    start, end = len(run) - len(run.lstrip(".")), len(run.rstrip("."))
    if end - start >= _LEAST and (start, end) not in seen and not covered.meets(offset + start, offset + end):
        yield offset + start, offset + end, formats.score(run[start:end])


def scan(text: str | None, formats: Formats) -> list[tuple[str, int, int, float | None]]:
    """All spans (kind, start, end, score of learned ones) by start, then kind."""
    base = base_spans(text)
    out = [(kind, s, e, None) for kind, s, e, _ in base]
    covered = Covered((s, e) for _, s, e, _ in base)
    found = []
    for m in _TOKEN.finditer(text or ""):
        for start, end, score in candidates(m.group(), m.start(), formats, covered):
            if score is not None and score >= formats.least_score:
                found.append((score * (end - start + 1), start, end, score))
    taken = Covered(())
    for _, start, end, score in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
        if not taken.meets(start, end):
            taken.add(start, end)
            out.append((FORMAT, start, end, score))
    return sorted(out, key=lambda s: (s[1], _RANK[s[0]]))


def find_secrets(formats: Formats, text: Column, spark) -> Column:
    """Array of structs (kind, start, end, score) of the text's spans."""
    shared = spark.sparkContext.broadcast(formats)  # bounded by the samples

    @F.pandas_udf("array<struct<kind:string,start:int,end:int,score:double>>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [[{"kind": k, "start": s, "end": e, "score": v} for k, s, e, v in scan(t, shared.value)] for t in texts],
                dtype=object,
            )

    return udf.asNondeterministic()(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by [kind]; overlapping spans become one, named by the first."""

    @F.pandas_udf("string")
    def udf(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(texts, found, strict=True):
            if t is None or spans is None or not len(spans):
                out.append(t)
                continue
            parts, at = [], 0
            for s in spans:
                if s["start"] >= at:
                    parts.append(t[at : s["start"]] + f"[{s['kind']}]")
                at = max(at, s["end"])
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    return udf(text, spans)
