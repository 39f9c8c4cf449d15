"""Line dedup by winnowing.

A run of lines counts from ``RUN`` lines or ``WORDS`` words on. Of the lines of
each shortest such run the one with the least hash is a fingerprint, so any two
equal runs are guaranteed to share one at the same place. Documents meet at the
positions of common fingerprints (see ``repeats``). In a run of documents that a
task meets, matches are extended line by line to both sides: all places that
agree so far are split by their next line at once, so that no pairs are made,
and in each class the earliest place is the reference. The shortest runs of
lines that nothing earlier among these documents has are compared with those of
all other tasks. Further than ``RUN`` - 1 lines an extension need not look, as
what follows has fingerprints of its own; pieces are joined in their document.

A line is deleted exactly if some run that counts and holds it starts earlier as
well, in a smaller doc_id or further up in the document itself; the earliest run
stays. Lines are compared by 128 bits of their hash, and by 96 between tasks.

Lines are what newlines separate, unchanged; words are what separates at ASCII
white space. Defined results: a null text is one
empty line, like an empty one; a null doc_id is smaller than any other (and the
least long counts as null); of rows
of one doc_id, equal runs at equal places don't repeat each other. Each row gets
a row. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tsforge.llm import repeats

#: Lines or words from which a run counts.
RUN, WORDS = 3, 8
#: Words of a place beyond its text.
NO_LINE = 255

_LINE = np.dtype([("low", "<u8"), ("high", "<u8"), ("words", "u1")])


class _Lines(dict):
    """What lines are compared by, for those that a worker has met."""

    def __missing__(self, line: bytes) -> bytes:
        found = self[line] = xxhash.xxh3_128_digest(line) + bytes([min(len(line.split()), NO_LINE - 1)])
        return found


_known = _Lines()


def _lines(text: bytes) -> list[bytes]:
    return text.split(b"\n")


def _described(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines of all texts, each one's text, and each text's first line."""
    if len(_known) > repeats.KEPT:
        _known.clear()
    lists = [_lines(t) for t in texts]
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    lines = np.frombuffer(b"".join(map(_known.__getitem__, chain.from_iterable(lists))), _LINE)
    return lines, np.repeat(np.arange(len(lists)), lengths), np.cumsum(lengths) - lengths


def _rank(lines: np.ndarray) -> np.ndarray:
    """What the least line is found by; lines without words come last, as they are common."""
    return np.where(lines["words"] > 0, lines["low"], np.iinfo(np.uint64).max)


def fingerprints(lines: np.ndarray, row: np.ndarray, run: int, words: int) -> np.ndarray:
    """The lines that have the least hash of a shortest run, the last of equals."""
    rank = _rank(lines)
    chosen = np.zeros(len(lines), bool)
    for length in range(1, run + 1):
        at = repeats.anchors_of(rank, length)
        n = len(at)
        inside = row[:n] == row[length - 1 : length - 1 + n]
        total = sum(lines["words"][i : i + n].astype(np.int64) for i in range(length)) if n else np.zeros(0, np.int64)
        chosen[at[inside & (total >= words if length < run else True)]] = True
    return np.flatnonzero(chosen)


def _refined(classes: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes split by one more line, and the first member of each one's class."""
    order = np.lexsort((high, low, classes))
    heads = repeats.groups(classes[order], low[order], high[order])
    counts = repeats.sizes(heads, len(order))
    split, first = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    split[order], first[order] = np.repeat(np.arange(len(heads)), counts), np.repeat(order[heads], counts)
    return split, first


def extended(around: np.ndarray, run: int):
    """For each shortest run of lines that holds its place as its fingerprint: (left, right), and the first of the places that agree there.

    ``around`` holds the ``run`` - 1 lines on either side of each place as well.
    Places are sorted by document and position, so the first is the earliest.
    """
    n, reach = len(around), run - 1
    low, high = around["low"], around["high"]
    classes = {(0, 0): _refined(np.zeros(n, np.int64), low[:, reach], high[:, reach])}
    for length in range(2, run + 1):
        for left in range(1 - length, 1):
            right = left + length - 1
            # one line more to the right, or to the left where there is none
            base, step = ((left, right - 1), right) if right else ((left + 1, right), left)
            classes[left, right] = _refined(classes[base][0], low[:, reach + step], high[:, reach + step])
    return {span: first for span, (_, first) in classes.items()}


def counting(around: np.ndarray, left: int, right: int, run: int, words: int) -> np.ndarray:
    """Whether the lines from left to right of each place are a run that counts, with the place as its fingerprint."""
    reach = run - 1
    lines = around[:, reach + left : reach + right + 1]
    there = (lines["words"] != NO_LINE).all(axis=1)
    enough = lines["words"].sum(axis=1, dtype=np.int64) >= words if right - left + 1 < run else True
    rank = _rank(lines)
    own = rank[:, -left, None]
    least = (own <= rank).all(axis=1) & (own < rank[:, 1 - left :]).all(axis=1)  # the last of equals
    return there & enough & least


class Runs(repeats.Rule):
    """Runs of lines, anchored by their least line; matches are found by extension."""

    within = True

    def __init__(self, lines: int, words: int, run: int = repeats.RUN, run_bytes: int = repeats.RUN_BYTES):
        self.lines, self.words, self.run, self.run_bytes = lines, words, run, run_bytes

    def anchors(self, texts):
        lines, row, first = _described(texts)
        at = fingerprints(lines, row, self.lines, self.words)
        return lines["low"][at], row[at], at - first[row[at]]

    def search(self, texts, docs, marks, live):
        lines, row, first = _described(texts)
        ends = np.append(first[1:], len(lines))
        at = np.concatenate([f + x[x < e - f] for x, f, e in zip(live, first.tolist(), ends.tolist())]).astype(np.int64)
        at = at[np.lexsort((at - first[row[at]], docs[row[at]]))]
        near = at[:, None] + np.arange(1 - self.lines, self.lines)
        outside = (near < first[row[at]][:, None]) | (near >= ends[row[at]][:, None])
        around = lines[np.clip(near, 0, len(lines) - 1)]
        around[outside] = (0, 0, NO_LINE)
        of, mark, pos = docs[row[at]], marks[row[at]], at - first[row[at]]
        found, left_over = [], []
        for (left, right), earliest in extended(around, self.lines).items():
            counts = counting(around, left, right, self.lines, self.words)
            later = (of != of[earliest]) | (pos != pos[earliest])
            again, new = np.flatnonzero(counts & later), np.flatnonzero(counts & ~later)
            n, ref = right - left + 1, earliest[again]
            found.append((of[again], mark[again], pos[again] + left, np.full(len(again), n), of[ref], pos[ref] + left))
            span = around[new][:, self.lines - 1 + left : self.lines + right]
            left_over.append((_key(span["low"]), _key(span["high"]) >> np.uint64(32), of[new], mark[new], pos[new] + left, np.full(len(new), n)))
        return tuple(tuple(np.concatenate(c) for c in zip(*x)) for x in (found, left_over))


def _key(hashes: np.ndarray) -> np.ndarray:
    """The hash of each row of hashes; rows of another length give others."""
    flat = np.ascontiguousarray(hashes).reshape(-1)
    n = hashes.shape[1]
    return repeats.gram_hashes(flat, n, 10 + n)[::n]


def _delete(batches):
    for batch in batches:
        sizes, deleted, kept = [], [], []
        for text, mark, data in zip(*(batch.column(k).to_pylist() for k in ("text", "mark", "data"))):
            lines = _lines(text)
            found = repeats.factors(data, mark)
            keep = np.ones(len(lines), bool)
            for start, count, _, _ in found:
                keep[start : start + count] = False
            sizes.append(len(lines))
            deleted.append(int(len(lines) - keep.sum()))
            kept.append(b"\n".join(x for x, k in zip(lines, keep.tolist()) if k) if found else text)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(deleted, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_lines", "n_deleted", "kept"])


def dedup(docs: DataFrame, lines: int = RUN, words: int = WORDS, run: int = repeats.RUN, run_bytes: int = repeats.RUN_BYTES) -> DataFrame:
    """doc_id, n_lines, n_deleted and kept (bytes) of each document."""
    return repeats.with_pieces(docs, Runs(lines, words, run, run_bytes)).mapInArrow(_delete, "doc_id long, n_lines long, n_deleted long, kept binary")
