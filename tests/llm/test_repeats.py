import random

import numpy as np
import pytest

from tsforge.llm import line_dedup, repeats, rlz, substring_dedup
from tsforge.llm.rlz import Block

ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "a b c " * 5000, None), (5, "a b c " * 5000, None), (6, "a b c " * 700 + "é\tü", "t")]


def brute(rows, split, join, lengths, counts, within):
    """Each token that lies in a window of one of the lengths, if it counts, that starts earlier as well."""
    key = lambda d: (d is not None, d or 0)
    texts = [(d, split((t or "").encode())) for d, t, _ in rows]
    windows = lambda tokens: ((i, w) for n in lengths for i in range(len(tokens) - n + 1) if counts(w := tuple(tokens[i : i + n])))
    first = {}
    for d, tokens in texts:
        for i, w in windows(tokens):
            first[w] = min(first.get(w, (key(d), i)), (key(d), i))
    out = []
    for d, tokens in texts:
        keep = [True] * len(tokens)
        for i, w in windows(tokens):
            if first[w] < (key(d), i) if within else first[w][0] < key(d):
                keep[i : i + len(w)] = [False] * len(w)
        out.append((d, len(tokens), keep.count(False), join(t for t, k in zip(tokens, keep) if k)))
    return sorted(out, key=str)


def passages(rng, unit, gap):
    shared = [gap.join(unit() for _ in range(rng.randrange(2, 60))) for _ in range(6)]
    for _ in range(150):
        parts = [gap.join(unit() for _ in range(rng.randrange(30)))]
        for _ in range(rng.randrange(3)):
            whole = rng.choice(shared).split(gap)
            a = rng.randrange(len(whole))
            parts += [gap.join(whole[a : a + rng.randrange(1, 60)]), gap.join(unit() for _ in range(rng.randrange(5)))]
        yield gap.join(parts)


@pytest.mark.parametrize("window,gram,run,run_bytes", [(13, 5, 1 << 21, 1 << 23), (4, 2, 300, 500), (3, 3, 1 << 21, 1), (2, 1, 50, 5000)])
def test_substrings_against_brute_force(documents, window, gram, run, run_bytes):
    rng = random.Random(window)
    rows = ODD + [(100 + i, t, "s") for i, t in enumerate(passages(rng, lambda: rng.choice("abcdefgh") * rng.randrange(1, 4), " "))]
    rows += [(1000 + i, rows[20][1], "s") for i in range(40)]
    found = substring_dedup.dedup(documents(rows, extra=True), window, gram, run, run_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found), key=str)
    assert got == brute(rows, bytes.split, b" ".join, (window,), lambda w: True, False)
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, []).append((t or "").encode().split())
    for r in found:
        if texts[r.doc_id][1:]:
            continue
        for s in r.spans:  # a factor's words stand at its reference
            mine = texts[r.doc_id][0][s.start : s.start + s.words]
            assert any(x[s.ref_start : s.ref_start + s.words] == mine for x in texts[s.ref_doc_id])


def test_same_id_never_repeats_itself(documents):
    rows = [(1, "a b c d", "s"), (1, "x a b c d", "s"), (2, "b c d", "s")]
    found = substring_dedup.dedup(documents(rows), 3, 2).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 3)]


@pytest.mark.parametrize("lines,words,run,run_bytes", [(3, 8, 1 << 21, 1 << 23), (3, 3, 100, 300), (2, 4, 100, 1), (1, 1, 50, 4000), (4, 6, 1 << 21, 1000)])
def test_lines_against_brute_force(documents, lines, words, run, run_bytes):
    rng = random.Random(lines)
    rows = [r for r in ODD if r[0] != 5] + [(5, "a\n" * 300, None), (5, "a\n" * 300, None), (7, "x\ny\nz\nq", "s"), (7, "x\ny\nz\nr", "s"), (8, "x\ny\nz", "s")]
    rows += [(100 + i, t, "s") for i, t in enumerate(passages(rng, lambda: f"line {rng.randrange(12)} " * rng.randrange(6), "\n"))]
    found = line_dedup.dedup(documents(rows, extra=True), lines, words, run, run_bytes).collect()
    got = sorted(((r.doc_id, r.n_lines, r.n_deleted, bytes(r.kept)) for r in found), key=str)
    enough = lambda w: len(w) == lines or sum(len(x.split()) for x in w) >= words
    assert got == brute(rows, lambda t: t.split(b"\n"), b"\n".join, range(1, lines + 1), enough, True)


def test_one_long_line_counts(documents):
    licence = "This text may be copied by anyone at any time."
    rows = ["a\n" + licence, licence + "\nb", "short\nc", "short\nd", licence]
    found = {r.doc_id: bytes(r.kept) for r in line_dedup.dedup(documents(rows)).collect()}
    assert found == {0: rows[0].encode(), 1: b"b", 2: b"short\nc", 3: b"short\nd", 4: b""}


def test_factors_are_parsed_greedily_against_the_index():
    """Each factor is as long as words agree with the earliest place; windows at its end are looked up again."""
    texts = [t.split() for t in (b"a b c d e f g h", b"x c d e f g q", b"b c d e f q", b"c d e f q f g q a b c d e")]
    block = Block(texts, np.array([1, 2, 3, 4]), 3)
    block.index()
    words = lambda at, n: b" ".join(block.words[at : at + n])
    found = [(int(block.docs[block.row[p]]), words(p, n), int(block.docs[block.row[q]])) for p, n, q in block.factors().tolist()]
    assert found == [(2, b"c d e f g", 1), (3, b"b c d e f", 1), (4, b"c d e f", 1), (4, b"e f q", 3), (4, b"f g q", 2), (4, b"a b c d e", 1)]
    assert all(words(p, n) == words(q, n) for p, n, q in block.factors().tolist())


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(rlz, "gram_hashes", lambda hashes, k, salt: np.zeros(len(hashes), np.uint64))
    block = Block([t.split() for t in (b"p q r", b"a b c d", b"x a b c d")], np.array([1, 2, 3]), 3)
    block.index()
    assert [(p, n, q) for p, n, q in block.factors().tolist()] == [(8, 4, 3)]


def test_slots_are_met_in_passes(documents, monkeypatch):
    monkeypatch.setattr(repeats, "HELD", 50)
    rng = random.Random(12)
    rows = [(i, t, "s") for i, t in enumerate(passages(rng, lambda: rng.choice("abcdefgh"), " "))]
    for packed in ([np.arange(5), np.arange(5) % 2], [np.zeros(0), np.zeros(0)]):
        assert [x.tolist() for x in repeats.unpack(repeats.pack(packed, ["<i8", "<u1"]), ["<i8", "<u1"])] == [x.tolist() for x in packed]
    parts = [repeats.pack([np.arange(100) % 9, np.arange(100)], ["<u8", "<i4"])] * 2
    found = list(repeats._passes(parts, ["<u8", "<i4"], lambda c: c[0]))
    assert len(found) == 5 and sorted(x for _, c in found for x in c.tolist()) == sorted([*range(100)] * 2)
    assert sum(len(set(k.tolist())) for k, _ in found) == 9
    got = sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in substring_dedup.dedup(documents(rows), 4, 2).collect()), key=str)
    assert got == brute(rows, bytes.split, b" ".join, (4,), lambda w: True, False)


def test_anchors_are_guaranteed():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 50, 500).astype(np.uint64)
    at = repeats.anchors_of(grams, 9)
    assert (np.diff(at) >= 0).all()
    for i, a in enumerate(at):
        assert i <= a < i + 9 and grams[a] == grams[i : i + 9].min()


def test_nothing(documents):
    assert substring_dedup.dedup(documents([])).count() == 0
    assert line_dedup.dedup(documents([])).count() == 0
