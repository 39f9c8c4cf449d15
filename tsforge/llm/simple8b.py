"""Simple-8b word-aligned coding of unsigned integers, whole arrays at a time.

A 64-bit word holds a selector in its top four bits and, below it, as many
values as fit at the selector's width. Values come in blocks of ``BLOCK``; no
word crosses from a block to the next, and a block's first word is known, so
blocks can be decoded on their own. Selector 0 is the escape: the word after it
is one raw value of more than 60 bits.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: for selectors 1 to 15, values in a word and bits for each.
COUNTS = (120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

BLOCK = 4096
_ESCAPE_AT = np.uint64(1) << np.uint64(60)


def _widths(values: np.ndarray) -> np.ndarray:
    """The least of BITS that holds each value; 61 for those that need an escape."""
    if len(values) and values.max() < len(_NARROW):
        return _NARROW[values.astype(np.uint16)]
    return _compared(values)


def _compared(values: np.ndarray) -> np.ndarray:
    needed = np.full(len(values), 61, np.uint8)
    for b in reversed(BITS):
        needed[values < (np.uint64(1) << np.uint64(b))] = b
    return needed


#: The widths of small values, by value.
_NARROW = _compared(np.arange(1 << 16, dtype=np.uint64))


def _choices(values: np.ndarray) -> np.ndarray:
    """For each position the selector that packs most values from there on."""
    n = len(values)
    widths = _widths(values)
    left = BLOCK - np.arange(n) % BLOCK
    left = np.minimum(left, n - np.arange(n))
    chosen = np.zeros(n, np.uint8)
    most, span = widths, 1  # most: the greatest width among the next `span` values
    for selector in range(15, 0, -1):
        count, bits = COUNTS[selector - 1], BITS[selector - 1]
        while span < count:
            step = min(span, count - span)
            ahead = np.full(n, 255, np.uint8)
            ahead[: n - step] = most[step:] if step < n else 0
            most, span = np.maximum(most, ahead), span + step
        chosen[(most <= bits) & (left >= count)] = selector
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, and where each block's first word is (one more for the end)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    chosen = _choices(values)
    step = np.array((1, *COUNTS), np.uint8)[chosen].tobytes()
    starts, i = [], 0
    put = starts.append
    while i < n:
        put(i)
        i += step[i]
    starts = np.array(starts)
    selectors = chosen[starts]
    at = np.cumsum(np.where(selectors == 0, 2, 1))
    words = np.zeros(at[-1], np.uint64)
    at = at - np.where(selectors == 0, 2, 1)
    for selector in np.unique(selectors).tolist():
        mine = selectors == selector
        first = starts[mine]
        if not selector:
            words[at[mine] + 1] = values[first]
            continue
        count, bits = COUNTS[selector - 1], BITS[selector - 1]
        word = np.full(len(first), np.uint64(selector) << np.uint64(60))
        if bits:
            for k in range(count):
                word |= values[first + k] << np.uint64(k * bits)
        words[at[mine]] = word
    heads = np.searchsorted(starts, np.arange(0, n, BLOCK))
    return words, np.r_[at[heads], len(words)].astype(np.int64)


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of some words that begin at a block."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw, after = [], -1
    for i in np.flatnonzero(selectors == 0).tolist():  # escapes are rare; a raw word may look like one
        if i != after:
            raw.append(i)
            after = i + 1
    escapes = np.array(raw, np.int64)
    is_raw = np.zeros(len(words) + 1, bool)
    is_raw[escapes + 1] = True
    held = np.array((1, *COUNTS), np.int64)[selectors]
    held[is_raw[: len(words)]] = 0
    ends = np.cumsum(held)
    out = np.zeros(n, np.uint64)
    for selector in range(1, 16):
        count, bits = COUNTS[selector - 1], BITS[selector - 1]
        mine = np.flatnonzero((selectors == selector) & (held > 0))
        if not len(mine) or not bits:
            continue
        first, word = ends[mine] - count, words[mine]
        mask = (np.uint64(1) << np.uint64(bits)) - np.uint64(1)
        for k in range(count):
            out[first + k] = (word >> np.uint64(k * bits)) & mask
    if len(escapes):
        out[ends[escapes] - 1] = words[escapes + 1]
    return out
