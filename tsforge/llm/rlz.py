"""Relative Lempel-Ziv factors of texts against an indexed block of texts.

A block's index is a table of the hashes of its windows, sorted, that names the
earliest place of each. A text is parsed greedily: the next window that the
index knows from an earlier document is its factor's start; from there words
themselves are compared until they differ or either text ends. The parse goes on
at the factor's last window but one word, so the windows that straddle a factor's
end are looked up on their own and none is lost at a boundary.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import chain

import numpy as np

from tsforge.llm.repeats import gram_hashes, groups, sizes, token_hashes


class Block:
    """Texts, end to end as words, each of a document."""

    def __init__(self, texts: list[list[bytes]], docs: np.ndarray, window: int):
        self.window, self.docs = window, docs
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(self.lengths) - self.lengths
        self.row = np.repeat(np.arange(len(texts)), self.lengths)
        self.words = list(chain.from_iterable(texts))
        self.hashes = token_hashes(self.words)
        room = np.repeat(self.first + self.lengths, self.lengths) - np.arange(len(self.words))
        self.whole = np.flatnonzero(room >= window)

    def index(self, starts: np.ndarray | None = None) -> None:
        """Index the windows that start at these places (all whole ones by default)."""
        self.starts = self.whole if starts is None else starts
        self.keys = gram_hashes(self.hashes, self.window, 5)[self.starts]
        of = self.docs[self.row[self.starts]]
        order = np.lexsort((of, self.keys))
        heads = groups(self.keys[order])
        earliest = np.empty(len(order), np.int64)
        earliest[order] = np.repeat(order[heads], sizes(heads, len(order)))
        self.known = of[earliest] < of
        self.earliest = self.starts[earliest]

    def common(self, p: int, q: int) -> int:
        """How many words are equal from these two places on, in their texts."""
        ends = [int(self.first[r] + self.lengths[r]) - x for x, r in ((p, self.row[p]), (q, self.row[q]))]
        words, limit, n, step = self.words, min(ends), 0, 32
        while n < limit:
            step = min(step, limit - n)
            if words[p + n : p + n + step] != words[q + n : q + n + step]:
                while words[p + n] == words[q + n]:
                    n += 1
                return n
            n, step = n + step, 4 * step
        return limit

    def _search(self, p: int) -> int | None:
        """The earliest place of the window at p, by its words: for windows that share a hash and differ."""
        (at,) = np.flatnonzero(self.starts == p)
        same = self.starts[self.keys == self.keys[at]]
        mine = self.docs[self.row[p]]
        for q in same[np.argsort(self.docs[self.row[same]], kind="stable")].tolist():
            if self.docs[self.row[q]] < mine and self.words[q : q + self.window] == self.words[p : p + self.window]:
                return q
        return None

    def factors(self) -> np.ndarray:
        """The factors of all texts: rows of (place, words, place in the reference)."""
        starts, refs = self.starts[self.known].tolist(), self.earliest[self.known].tolist()
        out, i = [], 0
        while i < len(starts):
            p, q = starts[i], refs[i]
            n = self.common(p, q)
            if n < self.window:
                q = self._search(p)
                n = 0 if q is None else self.common(p, q)
            if n:
                out.append((p, n, q))
                i = bisect_left(starts, p + n - self.window + 1, i + 1)
            else:
                i += 1
        return np.array(out, np.int64).reshape(-1, 3)

    def inside(self, at: np.ndarray) -> np.ndarray:
        """The places of words in their own texts."""
        return at - self.first[self.row[at]]
