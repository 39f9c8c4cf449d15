"""Byte-level BPE encoding and decoding with overlapping chunks.

A text of up to ``chunk`` characters is pre-tokenised and encoded where it is
read. A longer one is cut in chunks that overlap, and each chunk becomes a task
row of its own: its pre-tokens are found in parallel, and neighbours are
stitched at the first pre-token boundary that both of them see in the overlap.
From a common boundary on they agree, as a pre-token depends on nothing before
it. It does depend on what follows (white space before a word gives its last
character to the word), so a piece between two stitches is cut into pre-tokens
with the rest of its chunk behind it, and those that begin past its end are
left out. The pieces are encoded in parallel again, and their ids meet once,
for each document. Texts whose chunks never resynchronise (one pre-token as
long as the overlap) are encoded whole, in one task.

A pre-token's ids are kept in a bounded table, as most of them come again.
Decoding joins the bytes of the ids' tokens.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows each get a row; strings of special tokens are ordinary text; a
null doc_id stays null. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.llm.common import partitions, small_batches, text_of, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters in a chunk, and of the next chunk that it also holds.
CHUNK = 32_768
OVERLAP = 1_024
#: Pre-tokens whose ids a worker keeps.
KEPT = 150_000


class Codec:
    """A rank file's encoder for each worker; the file's bytes come from the driver."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        with open(path, "rb") as f:
            self.data, self.pattern = f.read(), pattern
        self._ready = False

    def __getstate__(self):
        return {"data": self.data, "pattern": self.pattern, "_ready": False}

    def _open(self):
        if not self._ready:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.data.splitlines())}
            self.encoding = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
            self.tokens = [b""] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                self.tokens[rank] = token
            self.split = regex.compile(self.pattern).findall
            encode = self.encoding.encode_ordinary

            class Pieces(dict):
                def __missing__(self, piece: str) -> bytes:
                    found = self[piece] = array("i", encode(piece)).tobytes()
                    return found

            self.kept = Pieces()
            self._ready = True

    def pieces(self, text: str) -> list[str]:
        self._open()
        return self.split(text)

    def ids(self, text: str, end: int | None = None) -> np.ndarray:
        """The ids of a text that begins at a pre-token boundary: of its pre-tokens before ``end``, which is a boundary as well."""
        pieces = self.pieces(text)
        if end is not None:
            pieces = pieces[: bisect_left(list(accumulate(map(len, pieces))), end) + 1] if end else []
        if len(self.kept) > KEPT:
            self.kept.clear()
        return np.frombuffer(b"".join(map(self.kept.__getitem__, pieces)), np.int32)

    def bytes(self, ids) -> bytes:
        self._open()
        return b"".join(map(self.tokens.__getitem__, ids))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), pa.int32()))


def _encode_texts(batches, codec: Codec, decoded: bool):
    for batch in batches:
        found = [codec.ids(t or "") for t in batch.column("text").to_pylist()]
        columns, names = [batch.column("doc_id"), _lists(found)], ["doc_id", "ids"]
        if decoded:
            columns.append(pa.array([codec.bytes(x.tolist()) for x in found], pa.binary()))
            names.append("bytes")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _chunks(batches, chunk: int, overlap: int):
    """Long texts to rows (row, doc_id, i, start, chunk with overlap)."""
    for batch in batches:
        for row, doc_id, text in zip(*(batch.column(k).to_pylist() for k in ("row", "doc_id", "text"))):
            starts = range(0, len(text), chunk)
            for i, at in enumerate(starts):
                yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc_id, "i": i, "start": at, "text": text[at : at + chunk + overlap]}], pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("i", pa.int32()), ("start", pa.int64()), ("text", pa.string())]))


def _boundaries(batches, codec: Codec, chunk: int, overlap: int):
    """The pre-token starts that a chunk sees in the overlaps before and after it."""
    for batch in batches:
        head, tail = [], []
        for start, text in zip(batch.column("start").to_pylist(), batch.column("text").to_pylist()):
            ends = np.fromiter(accumulate(map(len, codec.pieces(text)), initial=0), np.int64)[:-1]
            head.append((ends[ends < overlap] + start).tolist())
            tail.append((ends[ends >= chunk] + start).tolist())
        long_list = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("i"), pa.array(head, long_list), pa.array(tail, long_list)], names=["row", "i", "head", "tail"])


def _encode_spans(batches, codec: Codec):
    for batch in batches:
        cols = (batch.column(k).to_pylist() for k in ("text", "start", "from", "to"))
        found = [codec.ids(text[a - start :], None if b is None else b - a) for text, start, a, b in zip(*cols)]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in ("row", "doc_id", "i")] + [_lists(found)], names=["row", "doc_id", "i", "ids"])


def encode(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids (array<int>) for each document."""
    direct, stitched = _encoded(docs, path, pattern, chunk, overlap, decoded=False)
    return direct.unionByName(stitched)


def _encoded(docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int, decoded: bool) -> tuple[DataFrame, DataFrame]:
    """Documents that one task encoded, on request with their decoded ``bytes``, and those that were stitched."""
    spark = docs.sparkSession
    small_batches(spark)
    codec = Codec(path, pattern)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    is_long = F.length("text") > chunk
    short = base.filter(~is_long)
    cut = base.filter(is_long).withColumn("row", F.monotonically_increasing_id())
    chunks = written(cut.mapInArrow(lambda it: _chunks(it, chunk, overlap), "row long, doc_id long, i int, start long, text string"), "chunks")
    dealt = chunks.repartition(partitions(spark), "row", "i")
    seen = dealt.mapInArrow(lambda it: _boundaries(it, codec, chunk, overlap), "row long, i int, head array<long>, tail array<long>")
    in_order = Window.partitionBy("row").orderBy("i")
    seams = (
        seen.withColumn("next", F.lead("head").over(in_order))
        .select("row", "i", F.col("next").isNull().alias("last"), F.array_min(F.array_intersect("tail", "next")).alias("to"))
        .withColumn("from", F.coalesce(F.lag("to").over(in_order), F.lit(0).cast("long")))
        .withColumn("lost", F.max(F.col("to").isNull() & ~F.col("last")).over(Window.partitionBy("row")))
    )
    seams = written(seams, "seams")
    spans = chunks.join(seams.filter("not lost"), ["row", "i"]).select("row", "doc_id", "i", "text", "start", "from", "to")
    parts = spans.repartition(partitions(spark), "row", "i").mapInArrow(lambda it: _encode_spans(it, codec), "row long, doc_id long, i int, ids array<int>")
    stitched = parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("parts")).select("doc_id", F.flatten("parts.ids").alias("ids"))
    unsynchronised = chunks.join(seams.filter("lost").select("row").distinct(), "row", "left_semi")
    own = F.struct("i", F.substring("text", 1, chunk).alias("text"))
    whole = unsynchronised.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(own)).alias("parts")).select("doc_id", F.array_join("parts.text", "").alias("text"))
    schema = "doc_id long, ids array<int>" + ", bytes binary" * decoded
    direct = [x.mapInArrow(lambda it: _encode_texts(it, codec, decoded), schema) for x in (short, whole)]
    return direct[0].unionByName(direct[1]), stitched


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The input without ``ids`` and with ``bytes``, what the ids stand for, in place of a column of that name."""
    codec = Codec(path)
    keep = [f for f in encoded.schema.fields if f.name not in ("ids", "bytes")]
    names = [f.name for f in keep]

    def run(batches):
        for batch in batches:
            found = [codec.bytes(x.values.to_numpy().tolist()) if x.is_valid else b"" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), pa.array(found, pa.binary())], names=[*names, "bytes"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "bytes binary"])
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids as text and of what they decode to.

    A task that encodes a text decodes its ids as well, so that each needs one Python worker.
    """
    direct, stitched = _encoded(docs, path, pattern, chunk, overlap, decoded=True)
    ids_sha256 = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256")
    digested = ["doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_sha256]
    both = direct.select(*digested, "bytes").unionByName(decode(stitched.select(*digested, "ids"), path))
    return both.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
