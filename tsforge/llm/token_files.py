"""Token ids in a binary format of Simple-8b blocks.

Documents are tokenised where they are read; what is shuffled is their ids. The
quantiles of doc_id bound the shards, so shard after shard holds ascending ids.
A shard is written as blobs of about a million ids each. A blob is

    magic, documents, ids, words, blocks (five 64-bit integers)
    doc_id of each document; 1 for each null among them (a byte each)
    number of ids of each document, as Simple-8b words with their count
    first word of each block, and the end
    the words

all little-endian. Blobs are rows of a Parquet table, so that any store that
Spark writes to will do and a lost task leaves no half file; the columns beside
a blob say how many ids it holds. A reader needs one blob at a time.

Pre-tokens are encoded once while they stay in a bounded table: the tokenizer's
normaliser and splitter never look across white space.

Defined results: the tokenizer's added tokens (``<|endoftext|>``) in a text give
their own ids, as in the library; a null or empty text has the end id alone; a null doc_id comes
first; rows of equal doc_id come in the order of their ids' bytes; repeated rows
are all written. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from string import punctuation

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tsforge.llm import simple8b
from tsforge.llm.common import deal_exactly, partitions, sent_if_small, small_batches, written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 1
MAGIC = 0x3130534449534654
#: Ids after which a blob ends.
BLOB_IDS = 1 << 20
#: Pre-tokens, and words, whose ids a worker keeps.
KEPT = 400_000
#: Letters before this character have no decompositions that a normaliser would join.
LATIN_END = "\u0250"

BLOBS = "shard int, seq int, n_docs long, n_ids long, blob binary"


def _byte_characters() -> str:
    """The characters that stand for the 256 bytes in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(rest)) for b in range(256))


def _latin_pieces() -> re.Pattern:
    """The vocabulary's splitter for lower-case texts of the first 256 characters."""
    of = lambda kind: "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)
    letters, numbers, spaces = of("L"), of("N"), r"\t\n\x0b\x0c\r \x85\xa0"
    # letters come first, as most pieces are; what begins with an apostrophe is no letter
    return re.compile(f"[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d|[{numbers}]|[^{spaces}{letters}{numbers}]+")


class WordTokenizer:
    """A tokenizer for each worker; the file's text comes from the driver.

    ``encode`` gives a text's ids as packed integers. Texts of the first 256
    characters need no normaliser but lower case; their pre-tokens are found by
    one expression and given to the tokenizer's model once each. In other texts,
    and in those that may hold an added token, words go through the whole
    tokenizer, once each, unless they are Latin letters and then punctuation,
    which the model gets apart. No added token holds white space or begins with
    letters, so none is lost there.
    """

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as f:
            self.data = f.read()
        self._tokenizer = None

    def __getstate__(self):
        return {"data": self.data, "_tokenizer": None}

    def size(self) -> int:
        return 1 + max(json.loads(self.data)["model"]["vocab"].values())

    def _open(self, code: str):
        tokenizer = self._tokenizer = Tokenizer.from_str(self.data)
        added = [t["content"] for t in json.loads(self.data)["added_tokens"]]
        if any(not t or t[0].isalnum() or t.split() != [t] for t in added):
            raise ValueError("an added token begins with a letter or holds white space")
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        self.code = code
        characters = _byte_characters()
        model = tokenizer.model.tokenize

        def whole(text: str) -> bytes:
            return array(code, tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

        class Pieces(dict):
            """Ids of pre-tokens in lower case."""

            def __missing__(self, piece: str) -> bytes:
                units = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(characters)
                found = self[piece] = array(code, [t.id for t in model(units)]).tobytes()
                return found

        self.pieces = pieces = Pieces()
        self.split = _latin_pieces().findall

        class Words(dict):
            """Ids of words of texts that hold other characters."""

            def __missing__(self, word: str) -> bytes:
                stem = word.rstrip(punctuation)
                if stem.isalpha() and (stem.isascii() or max(stem) < LATIN_END and "\u0130" not in stem):
                    found = pieces[stem.lower()]
                    if len(stem) < len(word):
                        found += pieces[word[len(stem) :]]
                else:
                    found = whole(word)
                self[word] = found
                return found

        self.words = Words()

    def encode(self, text: str, code: str = "H") -> bytes:
        if self._tokenizer is None or self.code != code:
            self._open(code)
        for kept in (self.words, self.pieces):
            if len(kept) > KEPT:
                kept.clear()
        try:
            text.encode("latin-1")
            plain = not self.added(text)
        except UnicodeEncodeError:
            plain = False
        if plain:
            return b"".join(map(self.pieces.__getitem__, self.split(text.lower())))
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text, "I"), np.uint32)


def _tokenise(batches, tokenizer: WordTokenizer, bounds: np.ndarray, end: int, kind: str):
    for batch in batches:
        keys = batch.column("doc_id")
        shard = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(), "left")
        code, last = ("H" if kind == "<u2" else "I"), np.array([end], kind).tobytes()
        ids = [tokenizer.encode(t or "", code) + last for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), keys, pa.array(ids, pa.binary())], names=["shard", "doc_id", "ids"])


def pack(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A blob of these documents."""
    words, firsts = simple8b.encode(np.concatenate(ids))
    lengths, _ = simple8b.encode(np.array([len(x) for x in ids]))
    head = np.array([MAGIC, len(ids), sum(map(len, ids)), len(words), len(firsts) - 1], "<u8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join((head.tobytes(), keys.tobytes(), nulls.tobytes(), np.array([len(lengths)], "<u8").tobytes(), lengths.astype("<u8").tobytes(), firsts.astype("<i8").tobytes(), words.astype("<u8").tobytes()))


def unpack(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """A blob's doc_ids, the number of ids of each document, and all ids."""
    magic, docs, n, words, blocks = np.frombuffer(blob, "<u8", 5).tolist()
    if magic != MAGIC:
        raise ValueError("not a blob of token ids")
    at = 40
    keys = np.frombuffer(blob, "<i8", docs, at).tolist()
    nulls = np.frombuffer(blob, np.uint8, docs, at := at + 8 * docs)
    (size,) = np.frombuffer(blob, "<u8", 1, at := at + docs).tolist()
    lengths = simple8b.decode(np.frombuffer(blob, "<u8", size, at := at + 8), docs).astype(np.int64)
    at += 8 * size + 8 * (blocks + 1)
    ids = simple8b.decode(np.frombuffer(blob, "<u8", words, at), n)
    return [None if null else k for k, null in zip(keys, nulls.tolist())], lengths, ids


def unpack_block(blob: bytes, block: int) -> np.ndarray:
    """The ids of one block, without what comes before it."""
    _, docs, n, words, blocks = np.frombuffer(blob, "<u8", 5).tolist()
    at = 40 + 9 * docs
    (size,) = np.frombuffer(blob, "<u8", 1, at).tolist()
    firsts = np.frombuffer(blob, "<i8", blocks + 1, at := at + 8 + 8 * size)
    part = np.frombuffer(blob, "<u8", words, at + 8 * (blocks + 1))[firsts[block] : firsts[block + 1]]
    return simple8b.decode(part, min(simple8b.BLOCK, n - block * simple8b.BLOCK))


def _pack_sorted(batches, kind: str, limit: int):
    """Rows sorted by shard and doc_id to blobs."""
    shard, seq, keys, ids, total = None, 0, [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([total], pa.int64()), pa.array([pack(keys, ids)], pa.binary())], names=["shard", "seq", "n_docs", "n_ids", "blob"])

    for batch in batches:
        for s, k, x in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "ids"))):
            if ids and (s != shard or total >= limit):
                yield flush()
                seq = seq + 1 if s == shard else 0
                keys, ids, total = [], [], 0
            shard = s
            keys.append(k)
            ids.append(np.frombuffer(x, kind))
            total += len(ids[-1])
    if ids:
        yield flush()


def write(docs: DataFrame, path: str = VOCABULARY, end: int = END, blob_ids: int = BLOB_IDS) -> DataFrame:
    """Write the ids of all documents in ascending order of doc_id; the table of blobs, as read again."""
    spark = docs.sparkSession
    small_batches(spark)
    n = partitions(spark)
    tokenizer = WordTokenizer(path)
    kind = "<u2" if max(tokenizer.size(), end) < 1 << 16 else "<u4"
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = base.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))
    tokens = base.mapInArrow(lambda it: _tokenise(it, tokenizer, bounds, end, kind), "shard int, doc_id long, ids binary")
    in_order = deal_exactly(tokens, F.col("shard"), n).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    return written(in_order.mapInArrow(lambda it: _pack_sorted(it, kind, blob_ids), BLOBS), "token-blobs")


def _read(batches):
    for batch in batches:
        for base, blob in zip(batch.column("base").to_pylist(), batch.column("blob")):
            keys, lengths, ids = unpack(blob.as_py())
            ids = ids.astype("<u4")
            ends = np.cumsum(lengths)
            sums = [zlib.crc32(ids[e - k : e]) for e, k in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(base + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_index(blobs: DataFrame) -> DataFrame:
    """For each document in the blobs: doc_id, start (ids before it), n_tokens, ids_crc32."""
    small_batches(blobs.sparkSession)
    sizes = blobs.select("shard", "seq", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).select("shard", before(Window.orderBy("shard")).alias("shard_base"))
    inner = sizes.select("shard", "seq", before(Window.partitionBy("shard").orderBy("seq")).alias("inner_base"))
    bases = inner.join(shards, "shard").select("shard", "seq", (F.col("shard_base") + F.col("inner_base")).alias("base"))
    return blobs.join(sent_if_small(written(bases, "bases")), ["shard", "seq"]).select("base", "blob").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
