import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tsforge.llm import bpe, simple8b, token_files

ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "Word's \t\n  end <|endoftext|>  ", None), (5, "Word's \t\n  end <|endoftext|>  ", None), (6, "é́ ΑΣ ß  x 'S\x1c\x1f1234½", "t")]


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def prose(rng, n):
    ends = [" ", " ", " ", "  ", "\n", "'s ", "! ", " 12", "\n\n\t "]
    return "".join("".join(rng.choices("abcdeéñ", k=rng.randrange(1, 9))) + rng.choice(ends) for _ in range(n))


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1024), (50, 20), (97, 9)])
def test_bpe_equals_the_library(documents, reference, chunk, overlap):
    rng = random.Random(chunk)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(40)] + ["x" * 400 + " y", " " * 300 + "a", "!" * 500]
    rows = ODD + [(100 + i, t, "s") for i, t in enumerate(texts)]
    found = bpe.decode(bpe.encode(documents(rows, extra=True), chunk=chunk, overlap=overlap).selectExpr("doc_id", "ids", "array_join(ids, ' ') joined")).collect()
    got = sorted(((r.doc_id, r.joined, bytes(r.bytes)) for r in found), key=str)
    want = sorted(((d, " ".join(map(str, reference.encode_ordinary(t or ""))), (t or "").encode()) for d, t, _ in rows), key=str)
    assert got == want


def test_seams_after_white_space(documents, reference):
    """A cut must not change what white space before a word becomes; the default chunk and small ones."""
    rng = random.Random(11)
    gaps = ["\n\n", "  ", " \n", "\n \t", "\t\t\t", " ", "\n", "\r\n\r\n", "\u3000\u3000"]
    words = lambda n: "".join("".join(rng.choices("abcé1!'", k=rng.randrange(1, 6))) + rng.choice(gaps) for _ in range(n))
    fixed = "ab " * 10_922 + "\n\nword and more " * 3_000
    assert fixed[32_766:32_768] == "\n\n"
    for chunk, overlap in ((20, 10), (37, 16), (200, 50), (bpe.CHUNK, bpe.OVERLAP)):
        texts = [words(rng.randrange(5, 150)) for _ in range(60)] + [fixed, "x" + fixed] * (chunk == bpe.CHUNK) + [words(30_000)] * (chunk == bpe.CHUNK)
        found = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.round_trip(documents(texts), chunk=chunk, overlap=overlap).collect()}
        for i, t in enumerate(texts):
            ids = reference.encode_ordinary(t)
            assert found[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()), (chunk, t[:200])


def test_decode_takes_the_place_of_a_column(documents):
    rows = bpe.decode(bpe.encode(documents(["a b"])).selectExpr("*", "'x' as bytes")).collect()
    assert rows[0].asDict() == {"doc_id": 0, "bytes": bytearray(b"a b")}


def test_pieces_of_every_character(reference):
    codec = bpe.Codec()
    for first in range(0, 0x30000, 0x400):
        chars = [chr(c) for c in range(first, first + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}{c} {c}1" for c in chars)
        assert codec.ids(text).tolist() == reference.encode_ordinary(text), hex(first)


def test_bpe_query_digests(documents):
    row = bpe.round_trip(documents(["Hello world", ""])).orderBy("doc_id").collect()
    assert row[0].n_tokens == len(bpe.Codec().ids("Hello world")) and row[0].decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest()
    assert row[1].ids_sha256 == row[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip(documents([])).count() == 0


@pytest.mark.parametrize("kind", ["ids", "zeros", "wide", "raw", "mixed", "none"])
def test_simple8b_round_trip(kind):
    rng = np.random.default_rng(5)
    n = 10_007
    values = {
        "ids": rng.integers(0, 49_408, n), "zeros": np.zeros(n), "wide": rng.integers(0, 1 << 62, n), "none": np.zeros(0),
        "raw": rng.integers(0, 1 << 64, n, dtype=np.uint64), "mixed": rng.integers(0, 1 << 63, n, dtype=np.uint64) >> rng.integers(0, 63, n, dtype=np.uint64),
    }[kind].astype(np.uint64)
    words, firsts = simple8b.encode(values)
    assert (simple8b.decode(words, n if len(values) else 0) == values).all()
    for b in range(len(firsts) - 1):
        part = values[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]
        assert (simple8b.decode(words[firsts[b] : firsts[b + 1]], len(part)) == part).all()
    if kind == "zeros":
        assert len(words) < n / 60


def test_blob_round_trip():
    rng = np.random.default_rng(6)
    ids = [rng.integers(0, 1 << 16, k, dtype=np.uint64) for k in (1, 9000, 3)]
    blob = token_files.pack([None, 0, 7], ids)
    keys, lengths, flat = token_files.unpack(blob)
    assert keys == [None, 0, 7] and lengths.tolist() == [1, 9000, 3] and (flat == np.concatenate(ids)).all()
    assert (token_files.unpack_block(blob, 1) == flat[4096:8192]).all()


@pytest.mark.parametrize("blob_ids", [1 << 20, 64])
def test_token_files_equal_the_library(documents, blob_ids):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(7)
    rows = ODD + [(100 + i, prose(rng, rng.randrange(60)), "s") for i in range(80)]
    blobs = token_files.write(documents(rows, extra=True), blob_ids=blob_ids)
    found = sorted(token_files.read_index(blobs).collect(), key=lambda r: r.start)
    ids = {}
    for d, t, _ in rows:
        ids.setdefault(d, []).append(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    start = 0
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    for r in found:
        assert (r.start, r.ids_crc32) in [(start, zlib.crc32(x)) for x in ids[r.doc_id]]
        start += r.n_tokens
    assert start == sum(len(x) for xs in ids.values() for x in xs)


def test_token_files_of_nothing(documents):
    assert token_files.read_index(token_files.write(documents([]))).count() == 0


def test_words_may_be_tokenised_alone():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    mine = token_files.WordTokenizer()
    for first in range(0, 0x20000, 0x200):
        text = "".join(f"a{c} {c}b\n{c}" for c in (chr(x) for x in range(first, first + 0x200) if not 0xD800 <= x < 0xE000))
        assert mine.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(first)


def test_added_tokens_in_texts():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    mine = token_files.WordTokenizer()
    rng = random.Random(10)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<", "|", ">", "endoftext", "hi", "Word's", " ", "\n", "é", "é\u0301", "Ω", "1", "!"]
    for text in ["hi <|endoftext|> there", "<|endoftext|>", "<|endoftext|>" * 3, "a<|startoftext|>b", "Ω <|endoftext|>\u0301"] + ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(4000)]:
        assert mine.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_latin_words_skip_the_normaliser():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    mine = token_files.WordTokenizer()
    letters = [chr(c) for c in range(0x30, 0x260) if chr(c).isalnum()]
    rng = random.Random(8)
    for _ in range(3000):
        word = "".join(rng.choices(letters, k=rng.randrange(1, 9))) + "".join(rng.choices(".,!?'*#$%&_-", k=rng.randrange(4)))
        assert mine.ids(word).tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_latin_texts_are_split_as_the_library_splits_them():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    mine = token_files.WordTokenizer()
    rng = random.Random(9)
    every = [chr(c) for c in range(256)]
    common = list("ab'sStTrReElL  \n12½²ªµ.,!_")
    for i in range(6000):
        text = "".join(rng.choices(every if i % 2 else common, k=rng.randrange(30)))
        assert mine.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert mine.ids("".join(c + "a" for c in every)).tolist() == library.encode("".join(c + "a" for c in every), add_special_tokens=False).ids
