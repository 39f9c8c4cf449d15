"""Substring dedup by relative Lempel-Ziv parsing.

The reference of a document is every document of a smaller doc_id, in indexed
blocks, and a document is parsed against each that may hold a factor of
``WINDOW`` words or more. There are two kinds of blocks:

- Each run of documents that a task meets is one (``rlz.Block``). It is parsed
  against its own index greedily, by comparing words from the earliest place that
  the index names until they differ, and each window that straddles the end of a
  factor is looked up on its own.
- What nothing earlier in its run holds is looked up in blocks of the whole
  corpus, one for each slot of window hashes, which index the earliest place of
  all windows that runs could not settle (see ``repeats``). Winnowed anchors tell
  which windows stand in one document only; these are sent to no block.

The document then takes the factors that all blocks found, at each place that
which reaches furthest. As windows at factor boundaries are looked up as well,
nothing is lost there: a word is removed exactly if some window that covers it
also starts in a document of a smaller doc_id. Windows are judged on the input,
not on what is left. Between runs, 96 bits of hash stand for a window's words.

Defined results: a null text has no words; a null doc_id is smaller than any
other (and the least long counts as null); rows of one doc_id never repeat each other, and each gets a row. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tsforge.llm import repeats
from tsforge.llm.rlz import Block

#: Words in a window, and in the grams that anchor it.
WINDOW, GRAM = 13, 5

_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_doc_id", pa.int64()), ("ref_start", pa.int32())]))


class Windows(repeats.Rule):
    """Windows of words, anchored by the least of their grams; runs are parsed to factors."""

    def __init__(self, window: int, gram: int, run: int = repeats.RUN, run_bytes: int = repeats.RUN_BYTES):
        self.window, self.gram, self.run, self.run_bytes = window, gram, run, run_bytes

    def _anchored(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all grams, and the anchor of each whole window."""
        grams = repeats.gram_hashes(block.hashes, self.gram)
        return grams, repeats.anchors_of(grams, self.window - self.gram + 1)[block.whole]

    def anchors(self, texts):
        block = Block([t.split() for t in texts], np.zeros(len(texts), np.int64), self.window)
        grams, at = self._anchored(block)
        at = at[repeats.groups(at)]  # the least of a sliding span only moves on
        return grams[at], block.row[at], block.inside(at)

    def search(self, texts, docs, marks, live):
        block = Block([t.split() for t in texts], docs, self.window)
        _, anchors = self._anchored(block)
        repeated = np.zeros(len(block.words), bool)
        for first, n, at in zip(block.first.tolist(), block.lengths.tolist(), live):
            repeated[first + at[at < n]] = True
        block.index(block.whole[repeated[anchors]])
        at, words, ref = block.factors().T
        row, of = block.row[at], block.row[ref]
        found = docs[row], marks[row], block.inside(at), words, docs[of], block.inside(ref)
        # windows within a factor need no other block
        change = np.zeros(len(block.words) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + words - self.window + 1, -1)
        left = np.cumsum(change)[block.starts] == 0
        starts = block.starts[left]
        row, more = block.row[starts], repeats.gram_hashes(block.hashes, self.window, 7)[starts] >> np.uint64(32)
        return found, (block.keys[left], more, docs[row], marks[row], block.inside(starts), np.full(len(starts), self.window))


def _remove(batches):
    for batch in batches:
        sizes, removed, kept, spans = [], [], [], []
        for text, mark, data in zip(*(batch.column(k).to_pylist() for k in ("text", "mark", "data"))):
            words = text.split()
            found = repeats.factors(data, mark)
            keep = np.ones(len(words), bool)
            for start, count, _, _ in found:
                keep[start : start + count] = False
            sizes.append(len(words))
            removed.append(int(len(words) - keep.sum()))
            kept.append(b" ".join(w for w, k in zip(words, keep.tolist()) if k) if found else b" ".join(words))
            spans.append([{"start": s, "words": n, "ref_doc_id": None if d == repeats.NO_ID else d, "ref_start": r} for s, n, d, r in found])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, _SPAN)], names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, run: int = repeats.RUN, run_bytes: int = repeats.RUN_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (bytes) and spans (removed words with their references) of each document."""
    schema = "doc_id long, n_words long, n_removed long, kept binary, spans array<struct<start int, words int, ref_doc_id long, ref_start int>>"
    return repeats.with_pieces(docs, Windows(window, gram, run, run_bytes)).mapInArrow(_remove, schema)
