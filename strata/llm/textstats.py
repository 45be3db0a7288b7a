"""Counts per document and per line, for whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

from strata.llm.common import SPACES, Words, mix, powers

SYMBOLS = b"#*$%&|<>"


def _per(index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of a 0/1 or count array between consecutive entries of ``first``."""
    total = np.r_[0, np.cumsum(index, dtype=np.int64)]
    return total[first[1:]] - total[first[:-1]]


class TextStats:
    """Per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words. Lines are \\n-split.

    Line arrays: line_doc, words, distinct words, bytes and classes of bytes per line.
    """

    def __init__(self, texts: list[str | None]):
        w = self.w = Words(texts, lower=False)
        buf, n = w.buf, len(w.buf)
        hashes = w.hashes()
        self.n_words = np.diff(w.first)
        start_char = (buf & 0xC0) != 0x80
        self.word_chars = _per(start_char & ~np.isin(buf, SPACES), w.offset)
        self.symbol = np.isin(buf, np.frombuffer(SYMBOLS, dtype=np.uint8))
        self.n_symbols = _per(self.symbol, w.offset)

        # Lines: the separator after each text ends its last line.
        stops = np.flatnonzero(buf == 10)
        self.line_start = np.r_[0, stops[:-1] + 1]
        self.line_edges = np.r_[self.line_start, n]
        self.line_doc = np.searchsorted(w.offset, self.line_start, side="right") - 1
        self.lines_first = np.searchsorted(self.line_doc, np.arange(w.rows + 1))
        word_line = np.searchsorted(stops, w.start)
        self.line_words = np.bincount(word_line, minlength=len(stops))
        up, down = powers(n)
        total = np.r_[np.uint64(0), np.cumsum(w._value[buf] * up[:n], dtype=np.uint64)]
        line_hash = mix((total[stops] - total[self.line_start]) * down[self.line_start])
        key = mix(line_hash + mix(self.line_doc.astype(np.uint64)))
        _, first_at = np.unique(key, return_index=True)
        later = np.ones(len(stops), dtype=bool)
        later[first_at] = False
        self.line_repeats = later & (self.line_words > 0)
        self.n_dup_lines = _per(self.line_repeats, self.lines_first)

        # Distinct words per line.
        pair = mix(hashes + mix(word_line.astype(np.uint64)))
        _, at = np.unique(pair, return_index=True)
        self.line_distinct = np.bincount(word_line[at], minlength=len(stops))

        # Words covered by 3-word windows that the same text has twice or more.
        self.covered = np.zeros(len(hashes) + 2, dtype=bool)
        if len(hashes) >= 3:
            a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
            window = mix((hashes[:-2] * a + hashes[1:-1]) * b + hashes[2:] + mix(w.doc[:-2].astype(np.uint64)))
            whole = np.flatnonzero(w.doc[:-2] == w.doc[2:])
            order = whole[np.argsort(window[whole], kind="stable")]
            same = window[order[1:]] == window[order[:-1]]
            twice = order[np.r_[same, False] | np.r_[False, same]] if len(order) else order
            for k in range(3):
                self.covered[twice + k] = True
        self.covered = self.covered[: len(hashes)]
        self.n_repeat_words = _per(self.covered, w.first)

    def per_line(self, of_bytes: np.ndarray) -> np.ndarray:
        return _per(of_bytes, self.line_edges)
