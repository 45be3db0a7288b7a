"""SentencePiece encoding and decoding by suffix-array matching.

Per block of texts:

1. A text is prefixed with one space and every space becomes U+2581. No piece
   continues past a U+2581 that follows another character (checked when the
   model is loaded), so a text falls into chunks "spaces + non-spaces". The
   batch text is the concatenation of the block's distinct chunks, less those
   that the task has matched in an earlier block.
2. Its suffix array is built to the depth of the longest piece by prefix
   doubling on packed ranks. Every piece of the vocabulary is looked up in it
   by two binary searches, level by level; the range between them holds all
   its occurrences.
3. The occurrences are edges (start, end, score). Sorted by position, they are
   relaxed: for unigram models by the best-scored path from left to right over
   all chunks at once; for BPE models by contracting, in every chunk at once,
   the best-scored (then leftmost) edge that spans two adjacent tokens until
   none is left, which is the model's own merge order.
4. Characters that no piece covers become their UTF-8 byte pieces (the unknown
   id if the model has none).

Decoding joins the pieces, restores bytes and spaces and drops the prefix.
A literal U+2581 in a text is the same symbol as a space, so it decodes to a
space; every other text makes an exact round trip with byte pieces. A null
text has null ids, an empty text has no ids. Only identity-normalised models
are read; tokenizers are never trained here.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm.common import BLOCK_BYTES, trim

SPACE = "▁"
#: The public model that the queries use; its path is a parameter everywhere.
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Chunks that a task remembers; then it starts anew.
KEPT = 150_000
#: Characters of the batch text that one suffix array covers.
MATCHED = 300_000


class _Numbered(dict):
    """Numbers its keys in the order of their first use."""

    def __missing__(self, key: str) -> int:
        self[key] = len(self)
        return len(self) - 1


@dataclass
class Pieces:
    """A vocabulary: the text pieces by id, their scores, byte pieces and the unknown id."""

    kind: str  # "bpe" or "unigram"
    surface: list[str]  # every id's text; "" for control, unknown and byte pieces
    text_ids: np.ndarray
    scores: np.ndarray  # of text_ids
    byte_ids: np.ndarray  # 256 ids, or empty
    unknown: int

    def __post_init__(self):
        crossing = [s for s in self.surface if SPACE in s.lstrip(SPACE)]
        if crossing:
            raise ValueError(f"pieces that span words are not supported: {crossing[:3]}")
        words = [self.surface[i] for i in self.text_ids]
        self.longest = max(map(len, words), default=1)
        self.codes = np.zeros((len(words), self.longest), dtype=np.int64)
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        self.rank = np.unique(-self.scores, return_inverse=True)[1].astype(np.int64)  # 0 is the best score
        for k, w in enumerate(words):
            self.codes[k, : len(w)] = [ord(c) for c in w]
        self.byte_of = np.full(len(self.surface), -1)
        if len(self.byte_ids):
            self.byte_of[self.byte_ids] = np.arange(256)

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Pieces:
        """Read a model file; ``kind`` names its algorithm."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in ids]
        surface = ["" if special[i] else sp.id_to_piece(i) for i in ids]
        text_ids = np.array([i for i in ids if not special[i]])
        by_name = {sp.id_to_piece(i): i for i in ids if sp.is_byte(i)}
        byte_ids = np.array([by_name[f"<0x{b:02X}>"] for b in range(256)] if len(by_name) == 256 else [], dtype=np.int64)
        scores = np.array([sp.get_score(int(i)) for i in text_ids], dtype=np.float64)
        return cls(kind, surface, text_ids, scores, byte_ids, sp.unk_id())


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Positions sorted by their next ``depth`` symbols (or more), and the packed keys used.

    ``symbols`` are small positive ranks. Returns the array and levels
    (width, key per position); the keys of symbols i..i+width compare like them.
    """
    bits = int(symbols.max(initial=1)).bit_length()
    width = max(1, 62 // bits)
    n = len(symbols)
    key = np.zeros(n, dtype=np.int64)
    for k in range(width):
        key <<= bits
        key[: max(0, n - k)] |= symbols[k:]
    levels, have = [(width, key)], width
    order = np.argsort(key)
    while have < depth:
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.r_[0, np.cumsum(sorted_key[1:] != sorted_key[:-1])] + 1
        key = rank << 32
        key[: max(0, n - have)] |= rank[have:]
        order = np.argsort(key)
        have *= 2
    return order, levels


def occurrences(symbols: np.ndarray, pieces: Pieces, rank_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece index, start) of every occurrence of every piece; rank_of maps code points to ranks, 0 if absent."""
    order, levels = suffix_array(symbols, pieces.longest)
    width, key = levels[0]
    bits = int(symbols.max(initial=1)).bit_length()
    n = len(order)
    coded = rank_of[pieces.codes]
    inside = np.arange(pieces.longest)[None, :] < pieces.length[:, None]
    possible = np.flatnonzero(((coded > 0) | ~inside).all(axis=1))
    coded, length = coded[possible], pieces.length[possible]
    lo, hi = np.zeros(len(possible), dtype=np.int64), np.full(len(possible), n, dtype=np.int64)
    for at in range(0, pieces.longest, width):
        open_ = np.flatnonzero((length > at) & (lo < hi))
        if not len(open_):
            break
        low = np.zeros(len(open_), dtype=np.int64)
        high = np.zeros(len(open_), dtype=np.int64)
        for k in range(at, at + width):
            used = (length[open_] > k) if k < pieces.longest else np.zeros(len(open_), dtype=bool)
            symbol = coded[open_, min(k, pieces.longest - 1)]
            low = (low << bits) | np.where(used, symbol, 0)
            high = (high << bits) | np.where(used, symbol, (1 << bits) - 1)

        def bound(value: np.ndarray, after: bool) -> np.ndarray:
            a, b = lo[open_].copy(), hi[open_].copy()
            while (todo := a < b).any():
                mid = (a + b) >> 1
                pos = order[np.minimum(mid, n - 1)] + at
                got = np.where(pos < n, key[np.minimum(pos, n - 1)], 0)
                right = todo & ((got <= value) if after else (got < value))
                a = np.where(right, mid + 1, a)
                b = np.where(todo & ~right, mid, b)
            return a

        first, last = bound(low, False), bound(high, True)
        lo[open_], hi[open_] = first, last
    count = np.maximum(hi - lo, 0)
    # Positions lo..hi of the array for every piece, one after another.
    step = np.repeat((lo - (np.cumsum(count) - count)).astype(np.int32), count)
    step += np.arange(len(step), dtype=np.int32)
    return np.repeat(possible.astype(np.int32), count), order.astype(np.int32)[step]


def _split(chunk_of: np.ndarray, n_chunks: int) -> np.ndarray:
    return np.searchsorted(chunk_of, np.arange(n_chunks + 1))


#: Merges per chunk that all chunks of a batch make together; longer chunks go on alone.
ROUNDS = 64


def _contract(pieces: Pieces, n: int, chunk: np.ndarray, piece: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BPE relaxation: token starts and their piece (-1: none), by position."""
    # The edges by position: a counting sort into one row per start, one column per length.
    at = np.full((n, pieces.longest + 1), -1, dtype=np.int16 if len(pieces.scores) < 32767 else np.int32)
    at[start, pieces.length[piece]] = piece
    token, size = np.arange(n, dtype=np.int32), np.ones(n, dtype=np.int16)  # starts and lengths of the current tokens
    done = np.zeros(n, dtype=np.int16)  # lengths of the final tokens, by their starts
    owner = chunk
    for _ in range(ROUNDS):
        if not len(token):
            break
        joined = size[:-1] + size[1:]
        fits = np.flatnonzero((owner[1:] == owner[:-1]) & (joined <= pieces.longest))
        edge = at[token[fits], joined[fits]]
        fits, edge = fits[edge >= 0], edge[edge >= 0]
        # Best score, then leftmost, as one number; the best of each chunk.
        key = (pieces.rank[edge] << np.int64(32)) | fits
        own = owner[fits]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(fits) else fits
        left = (np.minimum.reduceat(key, heads) & np.int64(0xFFFFFFFF)) if len(heads) else heads
        live = np.zeros(chunk[-1] + 1, dtype=bool)
        live[owner[left]] = True
        keep = live[owner]
        done[token[~keep]] = size[~keep]
        size[left] += size[left + 1]
        keep[left + 1] = False
        token, size, owner = token[keep], size[keep], owner[keep]
    for lo, hi in zip(*_runs(owner), strict=True):
        done[token[lo:hi]] = _contract_long(pieces, at, token[lo:hi], size[lo:hi])
    token = np.flatnonzero(done)
    return token, at[token, done[token]]


def _runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end index of each run of equal values."""
    edges = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    return (np.r_[0, edges], np.r_[edges, len(owner)]) if len(owner) else (edges, edges)


def _contract_long(pieces: Pieces, at: np.ndarray, token: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same relaxation of one long chunk, edge by edge from a heap; final lengths by first token, 0 where merged away.

    A round above looks at the whole chunk for one merge; here a merge looks at
    its two neighbours.
    """
    n, longest, width = len(token), pieces.longest, at.shape[1]
    starts, sizes, rank = token.tolist(), size.tolist(), pieces.rank.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    edge_at = at.ravel().item

    def edge(i: int) -> int:
        """Rank of the piece that token i makes with the next one, or -1."""
        j = after[i]
        if j >= n or (joined := sizes[i] + sizes[j]) > longest:
            return -1
        piece = edge_at(starts[i] * width + joined)
        return rank[piece] if piece >= 0 else -1

    heap = [(r, i) for i in range(n - 1) if (r := edge(i)) >= 0]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not sizes[i] or edge(i) != r:
            continue  # one of the two has been merged since
        j = after[i]
        sizes[i] += sizes[j]
        sizes[j] = 0
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (i, before[i]):
            if k >= 0 and (r := edge(k)) >= 0:
                heapq.heappush(heap, (r, k))
    return np.array(sizes, dtype=np.int16)


def _best_path(pieces: Pieces, n: int, chunk: np.ndarray, piece: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unigram relaxation: the same result form as _contract, by the best-scored path per chunk."""
    least = pieces.scores.min(initial=0.0) - 10.0
    head = _split(chunk, int(chunk[-1]) + 1 if n else 0)
    first = head[chunk] if n else head
    # One-character edges without a piece, so that every position can be reached.
    single = np.ones(n, dtype=bool)
    single[start[pieces.length[piece] == 1]] = False
    e_start = np.r_[start, np.flatnonzero(single)]
    e_size = np.r_[pieces.length[piece], np.ones(single.sum(), dtype=np.int64)]
    e_piece = np.r_[piece, np.full(single.sum(), -1)]
    e_score = np.r_[pieces.scores[piece], np.full(single.sum(), least)]
    step = e_start + e_size - first[e_start]  # end inside the chunk: later steps only need earlier ones
    order = np.lexsort((-e_size, e_start + e_size, step))
    e_start, e_size, e_piece, e_score, step = (x[order] for x in (e_start, e_size, e_piece, e_score, step))
    # Best score of reaching the end of position i; `via` is the edge taken.
    reach, via = np.full(n + 1, -np.inf), np.full(n, -1)
    cuts = np.flatnonzero(np.r_[True, step[1:] != step[:-1]]) if len(step) else np.zeros(0, dtype=int)
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(step)], strict=True):
        s, end = e_start[lo:hi], e_start[lo:hi] + e_size[lo:hi] - 1
        total = e_score[lo:hi] + np.where(s == first[s], 0.0, reach[s - 1])
        heads = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
        top = np.maximum.reduceat(total, heads)
        winner = np.flatnonzero(total == np.repeat(top, np.diff(np.r_[heads, hi - lo])))
        winner = winner[np.r_[True, end[winner[1:]] != end[winner[:-1]]]]
        reach[end[winner]], via[end[winner]] = total[winner], lo + winner
    token, found = [], []
    at = head[1:] - 1  # walk back from every chunk's last position at once
    at = at[head[1:] > head[:-1]]
    while len(at):
        edge = via[at]
        token.append(e_start[edge])
        found.append(e_piece[edge])
        at = np.where(e_start[edge] > first[e_start[edge]], e_start[edge] - 1, -1)
        at = at[at >= 0]
    if not token:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    token, found = np.concatenate(token), np.concatenate(found)
    order = np.argsort(token)
    return token[order], found[order]


def _match(pieces: Pieces, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all chunks one after another, number of ids per chunk)."""
    points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int32)
    size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
    chunk = np.repeat(np.arange(len(chunks), dtype=np.int32), size)
    alphabet = np.unique(points)
    rank_of = np.zeros(0x110000, dtype=np.int32)
    rank_of[alphabet] = np.arange(1, len(alphabet) + 1)
    # Each chunk gets an end of its own rank: matches must not run on into the next one.
    end = len(alphabet) + 1
    ended = np.full(len(points) + len(chunks), end, dtype=np.int64)
    ended[np.arange(len(points)) + chunk] = rank_of[points]
    piece, start = occurrences(ended, pieces, rank_of)
    back = np.cumsum(ended != end, dtype=np.int32) - 1  # positions without the ends
    relax = _contract if pieces.kind == "bpe" else _best_path
    token, found = relax(pieces, len(points), chunk, piece, back[start])
    # Tokens without a piece are single characters: their bytes, or unknown.
    bare = np.flatnonzero(found < 0)
    lengths = np.ones(len(token), dtype=np.int64)
    ids = np.where(found >= 0, pieces.text_ids[found], pieces.unknown)
    if len(bare) and len(pieces.byte_ids):
        which, kind = np.unique(points[token[bare]], return_inverse=True)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in which]
        lengths[bare] = np.array([len(b) for b in raw])[kind]
        first = np.cumsum(lengths) - lengths
        out = np.zeros(int(lengths.sum()), dtype=np.int64)
        out[first] = ids
        padded = np.array([list(b.ljust(4, b"\0")) for b in raw])
        for k in range(4):
            longer = lengths[bare] > k
            out[first[bare[longer]] + k] = pieces.byte_ids[padded[kind[longer], k]]
        ids = out
    per_chunk = np.bincount(chunk[token], weights=lengths, minlength=len(chunks)).astype(np.int64)
    return ids.astype(np.int32), per_chunk


def _batches(chunks: Iterable[str]) -> Iterator[list[str]]:
    """Batches of at most MATCHED characters (or one chunk)."""
    batch, size = [], 0
    for c in chunks:
        if batch and size + len(c) > MATCHED:
            yield batch
            batch, size = [], 0
        batch.append(c)
        size += len(c)
    if batch:
        yield batch


class Encoder:
    """Encodes blocks of texts; chunks of earlier blocks are matched once, up to KEPT of them."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.known = _Numbered()
        self.ids, self.first, self.size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text."""
        if len(self.known) > KEPT or len(self.ids) > 8 * KEPT:
            self.clear()
        before = len(self.known)
        uses, edges = [], [0]
        for t in texts:
            if t:
                uses += map(self.known.__getitem__, _CHUNK.findall(SPACE + t.replace(" ", SPACE)))
            edges.append(len(uses))
        for chunks in _batches(islice(self.known, before, None)):
            ids, size = _match(self.pieces, chunks)
            self.first = np.r_[self.first, len(self.ids) + np.cumsum(size) - size]
            self.ids, self.size = np.r_[self.ids, ids], np.r_[self.size, size]
        uses = np.array(uses, dtype=np.int32)
        counts = self.size[uses]
        total = np.r_[0, np.cumsum(counts)]
        out = self.ids[np.repeat(self.first[uses] - total[:-1], counts) + np.arange(total[-1])]
        cut = total[np.array(edges)]
        return [None if t is None else out[a:b] for t, a, b in zip(texts, cut, cut[1:], strict=False)]


def decode_ids(pieces: Pieces, ids: list[int] | np.ndarray | None) -> str | None:
    if ids is None:
        return None
    ids = np.asarray(ids, dtype=np.int64)
    bytes_of = pieces.byte_of[ids]
    if not (bytes_of >= 0).any():
        out = "".join([pieces.surface[i] for i in ids])
    else:
        edges = np.flatnonzero(np.diff((bytes_of >= 0).astype(np.int8))) + 1
        parts = []
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(ids)], strict=True):
            if bytes_of[a] >= 0:
                parts.append(bytes(bytes_of[a:b].tolist()).decode("utf-8", "replace"))
            else:
                parts.append("".join([pieces.surface[i] for i in ids[a:b]]))
        out = "".join(parts)
    out = out.replace(SPACE, " ")
    return out[1:] if out.startswith(" ") else out


def _text_blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t or "")
        if size >= 2 * BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def encode(text: Column, model: str = DEFAULT_MODEL, kind: str = "bpe") -> Column:
    """Struct (ids, exact) of the text; ``exact`` says whether the ids decode to it (null for null).

    ``model`` must be readable where the tasks run.
    """

    @F.pandas_udf("ids array<int>, exact boolean")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(Pieces.load(model, kind))
        trim()
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            ids = [x for b in _text_blocks(texts) for x in encoder.encode(b)]
            exact = [None if t is None else decode_ids(encoder.pieces, x) == t for t, x in zip(texts, ids, strict=True)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "exact": pd.Series(exact, dtype=object)})
        del encoder
        trim()

    return udf.asNondeterministic()(text)  # evaluated once


def decode(ids: Column, model: str = DEFAULT_MODEL, kind: str = "bpe") -> Column:
    """The text of an array<int> of ids."""

    @F.pandas_udf("string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces.load(model, kind)
        for rows in batches:
            yield pd.Series([decode_ids(pieces, ids) for ids in rows], dtype=object)

    return udf(ids)
