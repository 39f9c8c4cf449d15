"""Wu-Manber search for many strings at once, over the bytes of many texts.

Strings of at least ``m`` bytes are searched by the last ``b`` of their first
``m``: a table tells, for each block of ``b`` bytes by its hash, how far every
start may move before such a block could end a string's first ``m`` bytes
there. Where it may not move, the block's bucket (strings by the hash of that
block and of their first bytes) says if any string can start, and the bytes
themselves are compared. A buffer is searched from many places in lockstep, so
each step is a few array operations.

Strings are runs of words, each with one space around every word, and texts
have the same form; so a string occurs where its bytes do.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

#: Bytes that a cursor walks through alone.
STRETCH = 1024
#: Strings shorter than this go by classes of like lengths, for one short string would keep all others from skipping.
LONG = 24
#: Entries of a shift table for each string and position, and the most of them.
ROOM, MOST = 2, 1 << 22

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _blocks(buffer: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` (1, 2, 4 or 8) bytes at each place, as numbers."""
    view = np.ndarray((len(buffer) - width + 1,), dtype=f"<u{width}", buffer=buffer, strides=(1,))
    return view[at].astype(np.uint64)


@dataclass
class _Class:
    """Strings of like lengths, with their tables."""

    m: int
    width: int
    bits: int
    shift: np.ndarray
    #: sorted hashes of (last block, first block), and of whole strings with their numbers
    starts: np.ndarray
    hashes: np.ndarray
    numbers: np.ndarray
    words: np.ndarray

    def slots(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)


def _both(last: np.ndarray, first: np.ndarray) -> np.ndarray:
    return (last * _MIX) ^ (first * np.uint64(0xC2B2AE3D27D4EB4F))


class Strings:
    """Distinct strings given as spans (start, end) of one buffer, with their counts of words."""

    def __init__(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray, words: np.ndarray):
        data = np.frombuffer(buffer + bytes(8), np.uint8)
        self.buffer, self.starts, self.ends = buffer, starts, ends
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(buffer[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
        lengths = ends - starts
        kind = np.where(lengths >= LONG, 0, np.frexp(lengths.astype(float))[1])
        self.classes = []
        for k in np.unique(kind):
            own = np.flatnonzero(kind == k)
            m = int(lengths[own].min())
            width = next(w for w in (8, 4, 2, 1) if w <= max(1, m // 2))
            positions = m - width + 1
            bits = int(min(MOST, max(1 << 12, ROOM * len(own) * positions))).bit_length()
            part = _Class(m, width, bits, np.full(1 << bits, min(positions, 255), np.uint8), *[np.empty(0)] * 3, np.unique(words[own]))
            for i in range(positions):  # later positions leave less to move
                part.shift[part.slots(_blocks(data, starts[own] + i, width))] = min(positions - 1 - i, 255)
            part.starts = np.unique(_both(_blocks(data, starts[own] + positions - 1, width), _blocks(data, starts[own], width)))
            order = own[np.argsort(hashes[own], kind="stable")]
            part.hashes, part.numbers = hashes[order], order
            self.classes.append(part)

    def _ends(self, part: _Class, data: np.ndarray, size: int) -> np.ndarray:
        """Places where the tables let a string of the class start."""
        last = size - part.m
        if last < 0:
            return np.empty(0, np.int64)
        at = np.arange(0, last + 1, STRETCH, dtype=np.int64)
        stop = np.minimum(at + STRETCH, last + 1)
        found = []
        offset = part.m - part.width
        while len(at):
            blocks = _blocks(data, at + offset, part.width)
            move = part.shift[part.slots(blocks)].astype(np.int64)
            here = np.flatnonzero(move == 0)
            if len(here):
                keys = _both(blocks[here], _blocks(data, at[here], part.width))
                place = np.minimum(np.searchsorted(part.starts, keys), len(part.starts) - 1)
                found.append(at[here[part.starts[place] == keys]])
                move[here] = 1
            at += move
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def search(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all strings in a text: starts, ends, numbers."""
        data = np.frombuffer(text + bytes(8), np.uint8)
        spaces = None
        out: list[tuple[int, int, int]] = []
        for part in self.classes:
            starts = self._ends(part, data, len(text))
            if not len(starts):
                continue
            if spaces is None:
                spaces = np.flatnonzero(data[: len(text)] == 32)
            first = np.searchsorted(spaces, starts)
            for n in part.words.tolist():
                inside = first + n < len(spaces)
                begin = starts[inside].tolist()
                until = (spaces[first[inside] + n] + 1).tolist()
                hashes = np.fromiter((xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(begin, until)), np.uint64, len(begin))
                low, high = np.searchsorted(part.hashes, hashes), np.searchsorted(part.hashes, hashes, "right")
                for i in np.flatnonzero(low < high).tolist():
                    said = text[begin[i] : until[i]]
                    for number in part.numbers[low[i] : high[i]].tolist():
                        if self.buffer[self.starts[number] : self.ends[number]] == said:
                            out.append((begin[i], until[i], number))
        found = np.array(out, np.int64).reshape(-1, 3)
        return found[:, 0], found[:, 1], found[:, 2]
