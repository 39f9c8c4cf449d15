"""The exchange that finds what repeats across a corpus: winnowed anchors, then what stands around them.

All windows of all documents would be too many to exchange, so:

1. Every k-gram of tokens is hashed, and of the k-grams of each window the least
   is kept as an anchor (winnowing). Each window holds one, and equal windows
   hold it at the same place.
2. Anchors are exchanged by hash. Those that occur once need no more work.
3. Runs of documents are searched for what repeats in them around anchors that
   occur again. How is up to the rule: ``substring_dedup`` parses texts against an
   index of the run, ``line_dedup`` extends matches from their common line.
4. Windows around such anchors that no earlier place of the run has are sent by
   their own hash (96 bits) and meet those of all other runs; the earliest place
   is the reference. Dealing them by anchor would bring all that stands around a
   very common one to a single task.
5. What was found to repeat (pieces: tokens and the place of their reference)
   comes back to its document.

Before either exchange a task settles what it can among its own documents: of
places that it knows to repeat it sends one witness, so a passage that a third
of all documents hold costs each task one entry, and no task receives a group.
There is a slot to a partition. A task holds its slot packed, and unpacks and
sorts ``HELD`` entries of it at a time, by bits of their hash.

Documents are dealt by their id once; the plan reuses that exchange each time
their texts are needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import deal_exactly, partitions, small_batches, text_of

#: Entries that a task holds before it sends them, and bytes of texts that it compares with each other.
RUN, RUN_BYTES = 1 << 21, 12 << 20
#: Entries that a slot unpacks at a time, about.
HELD = 1 << 21
#: Distinct tokens whose hashes a worker keeps.
KEPT = 400_000

NO_ID = -(1 << 63)

# What is packed of an anchor (hash, more bits of it, document, place), of a window (hash, more bits of it, document, mark,
# place, tokens), of a place for its document, and of a piece (mark, place, tokens, document and place of the reference).
ANCHOR, WINDOW = ["<u4", "<u2", "<i8", "<i4"], ["<u8", "<u4", "<i8", "<i4", "<i4", "<u1"]
PLACE, PIECE = ["<i4"], ["<i4", "<i4", "<i4", "<i8", "<i4"]


class Rule:
    """What is looked for; ``within`` lets a document's own earlier places count."""

    within = False
    #: Anchors that a task holds before it sends them, and bytes of texts whose surroundings it sends at a time.
    run, run_bytes = RUN, RUN_BYTES

    def anchors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each anchor of the texts, in order: its hash, its text's number, its place in the text."""
        raise NotImplementedError

    def search(self, texts: list[bytes], docs: np.ndarray, marks: np.ndarray, live: list[np.ndarray]) -> tuple[tuple, tuple]:
        """A run of texts with their live anchors: the pieces that repeat in it, and the windows that nothing earlier in it has.

        Pieces are (docs, marks, start, count, docs and start of the reference),
        windows are (hash, more bits of it, docs, marks, start, count), as arrays.
        """
        raise NotImplementedError


class _Hashes(dict):
    """Hashes of tokens that a worker has met."""

    def __missing__(self, token: bytes) -> int:
        found = self[token] = xxhash.xxh3_64_intdigest(token)
        return found


_hashes = _Hashes()


def token_hashes(tokens: list[bytes]) -> np.ndarray:
    if len(_hashes) > KEPT:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A bijective finaliser."""
    x = x + np.uint64(salt)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """For each position the hash of the k tokens from there on (the last k - 1 are of no use)."""
    base = np.uint64(0x9E3779B97F4A7C15 + 2 * salt)
    out = np.zeros(len(hashes), np.uint64)
    for j in range(min(k, len(hashes))):
        out *= base
        out[: len(hashes) - j] += hashes[j:]
    return _mix(out, 1 + salt)


def anchors_of(grams: np.ndarray, span: int) -> np.ndarray:
    """For each position that begins a span of grams: the place of the least of them, the last of equals."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, span):
        here = grams[j : n + j]
        lower = here <= least
        np.copyto(least, here, where=lower)
        np.copyto(at, j, where=lower)
    return np.arange(n) + at


def pack(columns: list[np.ndarray], kinds: list[str]) -> bytes:
    """Equally long columns as planes of bytes, one after the other: the upper bytes of small numbers compress away."""
    planes = [np.ascontiguousarray(c, kind).view(np.uint8).reshape(len(c), np.dtype(kind).itemsize).T.tobytes() for c, kind in zip(columns, kinds, strict=True)]
    return len(columns[0]).to_bytes(8, "little") + b"".join(planes)


def unpack(data: bytes, kinds: list[str]) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def _passes(parts: list[bytes], kinds: list[str], bits):
    """All entries of the parts, ``HELD`` of them or so at a time; equal ones of ``bits`` (of the columns) come together."""
    passes = 1 + sum(int.from_bytes(p[:8], "little") for p in parts) // HELD
    for i in range(passes):
        found = []
        for data in parts:
            columns = unpack(data, kinds)
            if passes > 1:
                mine = np.flatnonzero(_mix(bits(columns), 9) % np.uint64(passes) == i)
                columns = [c[mine] for c in columns]
            found.append(columns)
        yield [np.concatenate(c) for c in zip(*found)]


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where groups of equal keys begin, in arrays that are sorted by them."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


_SENT = "slot int, dest int, data binary"


def _sent(slot, dest, data: list[bytes]) -> pa.RecordBatch:
    column = lambda x: pa.nulls(len(data), pa.int32()) if x is None else pa.array(x, pa.int32())
    return pa.RecordBatch.from_arrays([column(slot), column(dest), pa.array(data, pa.binary())], names=["slot", "dest", "data"])


def _to_documents(docs: np.ndarray, columns: list[np.ndarray], kinds: list[str], slots: int) -> pa.RecordBatch:
    """Rows for documents, packed for each destination."""
    dest = (_mix(docs.astype(np.uint64), 3) % np.uint64(slots)).astype(np.int32)
    order = np.argsort(dest, kind="stable")
    starts = groups(dest[order])
    parts = [pack([c[order[a : a + n]] for c in (docs, *columns)], ["<i8", *kinds]) for a, n in zip(starts.tolist(), sizes(starts, len(dest)).tolist())]
    return _sent(None, dest[order][starts], parts)


def _gather(batches, kinds: list[str]):
    """What documents were sent, as one row for each: key, and its rows packed."""
    parts = [data for batch in batches for data in batch.column("data").to_pylist()]
    for docs, *columns in _passes(parts, ["<i8", *kinds], lambda c: c[0].view(np.uint64)) if parts else ():
        order = np.argsort(docs, kind="stable")
        docs, columns = docs[order], [c[order] for c in columns]
        starts = groups(docs)
        ends = np.append(starts[1:], len(docs))
        for first in range(0, len(starts), 10_000):
            some = list(zip(starts[first : first + 10_000].tolist(), ends[first : first + 10_000].tolist()))
            packed = [pack([c[a:b] for c in columns], kinds) for a, b in some]
            yield pa.RecordBatch.from_arrays([pa.array(docs[starts[first : first + 10_000]]), pa.array(packed, pa.binary())], names=["key", "data"])


def _send_anchors(batches, rule: Rule, slots: int):
    """Texts to packed anchors for each slot, and to places already known to repeat for each document."""
    held, size = [], 0

    def flush():
        grams, docs, pos = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((docs, grams))
        grams, docs, pos = grams[order], docs[order], pos[order]
        starts = groups(grams)
        counts = sizes(starts, len(grams))
        last = docs[starts + counts - 1]
        repeats = (counts > 1) if rule.within else (docs[starts] != last)
        known = np.repeat(repeats, counts)
        # one witness stands for the places that are known to repeat
        send = ~known
        send[starts[repeats]] = True
        pos_sent = np.where(known, -1, pos)[send]
        columns = _anchor_columns(grams[send], docs[send], pos_sent)
        yield from by_slot((grams[send] % np.uint64(slots)).astype(np.int32), lambda at: pack([c[at] for c in columns], ANCHOR))
        if known.any():
            yield _places(docs[known], pos[known], slots)

    for batch in batches:
        if not batch.num_rows:
            continue
        grams, row, pos = rule.anchors([t.as_py() for t in batch.column("text")])
        held.append((grams, batch.column("key").to_numpy()[row], pos.astype(np.int32)))
        size += len(pos)
        if size >= rule.run:
            yield from flush()
            held, size = [], 0
    if size:
        yield from flush()


def by_slot(slot: np.ndarray, packed):
    order = np.argsort(slot, kind="stable")
    starts = groups(slot[order])
    if len(starts):
        parts = [packed(order[a : a + n]) for a, n in zip(starts.tolist(), sizes(starts, len(order)).tolist())]
        yield _sent(slot[order][starts], None, parts)


def _anchor_columns(grams, docs, pos) -> list[np.ndarray]:
    return [(grams >> np.uint64(16)).astype(np.uint32), (grams >> np.uint64(48)).astype(np.uint16), docs, pos]


def _places(docs: np.ndarray, pos: np.ndarray, slots: int) -> pa.RecordBatch:
    return _to_documents(docs, [pos], PLACE, slots)


def _settle(batches, finish):
    """A slot's rows: those for documents pass, the others meet in ``finish``."""
    held = []
    for batch in batches:
        direct = batch.column("dest").is_valid()
        if direct.true_count:
            yield batch.filter(direct)
        held += batch.filter(pa.array(~direct.to_numpy(zero_copy_only=False))).column("data").to_pylist()
    if held:
        yield from finish(held)


def _live_anchors(parts: list[bytes], rule: Rule, slots: int):
    for low, high, docs, pos in _passes(parts, ANCHOR, lambda c: c[0].astype(np.uint64)):
        order = np.lexsort((docs, low, high))
        low, high, docs, pos = low[order], high[order], docs[order], pos[order]
        starts = groups(low, high)
        counts = sizes(starts, len(low))
        if not len(starts):
            continue
        # a witness stands for at least two places
        seen = np.logical_or.reduceat(pos < 0, starts)
        repeats = seen | ((counts > 1) if rule.within else (docs[starts] != docs[starts + counts - 1]))
        live = np.repeat(repeats, counts) & (pos >= 0)
        if live.any():
            yield _places(docs[live], pos[live], slots)


def pieces(docs, marks, start, count, ref_docs, ref_start, slots: int) -> pa.RecordBatch:
    """Repeated tokens with their references, for the documents that hold them."""
    return _to_documents(docs, [marks, start, count, ref_docs, ref_start], PIECE, slots)


def _send(batches, rule: Rule, slots: int):
    """Texts with their live anchors to pieces for documents and windows for slots, a run of texts at a time."""
    texts, docs, marks, live, size = [], [], [], [], 0

    def flush():
        found, (key, more, of, mark, start, count) = rule.search(texts, np.array(docs, np.int64), np.array(marks, np.int32), live)
        if len(found[0]):
            yield pieces(*found, slots)
        columns = [key, more.astype(np.uint32), of, mark, start, count.astype(np.uint8)]
        yield from by_slot((key % np.uint64(slots)).astype(np.int32), lambda at: pack([c[at] for c in columns], WINDOW))

    for batch in batches:
        for text, key, mark, data in zip(*(batch.column(k).to_pylist() for k in ("text", "key", "mark", "data"))):
            texts.append(text)
            docs.append(key)
            marks.append(mark)
            live.append(unpack(data, PLACE)[0])
            size += len(text)
            if size >= rule.run_bytes:
                yield from flush()
                texts, docs, marks, live, size = [], [], [], [], 0
    if texts:
        yield from flush()


def _match(parts: list[bytes], rule: Rule, slots: int):
    """A slot's windows, from all runs, to the pieces that they make of what stands later than their earliest place."""
    for key, more, docs, marks, start, count in _passes(parts, WINDOW, lambda c: c[0]):
        order = np.lexsort((start, docs, more, key))
        heads = groups(key[order], more[order])
        first = np.repeat(order[heads], sizes(heads, len(order)))
        repeats = docs[order] != docs[first]
        if rule.within:
            repeats |= start[order] != start[first]
        at, ref = order[repeats], first[repeats]
        if len(at):
            yield pieces(docs[at], marks[at], start[at], count[at], docs[ref], start[ref], slots)


def with_pieces(docs: DataFrame, rule: Rule) -> DataFrame:
    """Each document (doc_id, mark, text as binary) with ``data``, its packed pieces or null."""
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    # the same two columns each time, so that the exchange is reused
    dealt = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), text_of().cast("binary").alias("text")).repartition(n, "key")
    # what tells rows of one doc_id apart
    mark = F.shiftright(F.xxhash64("text"), 32).cast("int").alias("mark")

    def settled(sent: DataFrame, finish, kinds) -> DataFrame:
        met = deal_exactly(sent, F.coalesce("slot", "dest"), n).mapInArrow(lambda it: _settle(it, finish), _SENT)
        return deal_exactly(met, F.col("dest"), n).mapInArrow(lambda it: _gather(it, kinds), "key long, data binary")

    places = settled(dealt.mapInArrow(lambda it: _send_anchors(it, rule, n), _SENT), lambda parts: _live_anchors(parts, rule, n), PLACE)
    live = dealt.join(places, "key").select("key", mark, "text", "data")
    found = settled(live.mapInArrow(lambda it: _send(it, rule, n), _SENT), lambda parts: _match(parts, rule, n), PIECE)
    return dealt.join(found, "key", "left").select(F.expr(f"nullif(key, {NO_ID + 1} - 1)").alias("doc_id"), mark, "text", "data")


def factors(data: bytes | None, mark: int) -> list[tuple[int, int, int, int]]:
    """A document's pieces, each token in one of them: at each place that which reaches furthest; (start, count, ref_doc, ref_start)."""
    if data is None:
        return []
    marks, start, count, ref_doc, ref_start = unpack(data, PIECE)
    order = np.lexsort((-count, start))
    out, reach = [], -1
    for own, begin, n, doc, ref in zip(*(c[order].tolist() for c in (marks, start, count, ref_doc, ref_start))):
        if own == mark and begin + n > reach:
            skip = max(0, reach - begin)  # the reference goes on as the piece does
            out.append((begin + skip, n - skip, doc, ref + skip))
            reach = begin + n
    return out
