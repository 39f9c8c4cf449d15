import random
from collections import defaultdict

import numpy as np
import pytest

from tsforge.llm import exact_dedup, golomb, simhash

ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "a b c " * 5000, None), (5, "a b c " * 5000, None), (6, "a b c " * 5000, "t"), (7, "é\tü", "t"), (None, "é\tü", "t")]


@pytest.mark.parametrize("n,width", [(0, 64), (1, 64), (1000, 60), (5000, 13), (300_000, 64)])
def test_golomb_round_trip(n, width):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, (1 << width) - 1, n, dtype=np.uint64, endpoint=True))
    rice = golomb.rice_parameter(n, width)
    data = golomb.encode(values, rice)
    assert (golomb.decode(data, n, rice) == values).all()
    if n == 300_000:
        assert len(data) < 0.8 * 8 * n


def brute_exact(rows):
    by = defaultdict(list)
    for doc_id, text, _ in rows:
        by[text or ""].append(doc_id)
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted(((d, top(by[t or ""]), len(by[t or ""])) for d, t, _ in rows), key=str)


@pytest.mark.parametrize("extra", [False, True])
def test_exact_dedup_against_brute_force(documents, extra):
    rng = random.Random(1)
    rows = ODD + [(100 + i, f"text {rng.randrange(60)}", "s") for i in range(300)] + [(1000 + i, "hot", "s") for i in range(500)]
    docs = documents(rows, extra)
    found = exact_dedup.classes(docs, run_rows=50).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == brute_exact(rows)
    assert sum(r.kept for r in found) == len({t or "" for _, t, _ in rows})
    left = exact_dedup.dedup(docs)
    assert left.columns == docs.columns
    assert sorted(r.text or "" for r in left.collect()) == sorted({t or "" for _, t, _ in rows})


def test_exact_dedup_of_nothing(documents):
    assert exact_dedup.classes(documents([])).count() == 0
    assert exact_dedup.dedup(documents([])).count() == 0


def brute_simhash(rows):
    fps = [simhash.fingerprint((t or "").encode()) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r[0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(((r[0], fps[i], least(groups[find(i)])) for i, r in enumerate(rows)), key=str)


def near_copies(rng, n):
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    for _ in range(n):
        words = list(base)
        words[rng.randrange(400)] = f"x{rng.randrange(9)}"
        yield " ".join(words)


def test_simhash_against_brute_force(documents):
    rng = random.Random(2)
    texts = list(near_copies(rng, 60)) + list(near_copies(rng, 5)) + [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(12))) for _ in range(200)]
    rows = ODD + [(100 + i, t, "s") for i, t in enumerate(texts)]
    found = simhash.groups(documents(rows, extra=True)).collect()
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found), key=str)
    assert got == brute_simhash(rows)


def test_simhash_chunks_of_a_hot_key_give_the_same_components(spark, documents):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (400, 2), dtype=np.uint64)
    values = np.unique((base[rng.integers(0, 4, 400)] ^ flips[:, 0] ^ flips[:, 1])).view(np.int64)
    df = spark.createDataFrame([(int(v),) for v in values], "fp long")
    roots = [{r.node: r.root for r in simhash.components(simhash.links(df, chunk)).collect()} for chunk in (4096, 7)]
    assert roots[0] == roots[1] and len(roots[0]) > 300


def test_simhash_of_a_short_text_is_its_hash():
    import xxhash

    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)
    assert simhash.fingerprint(b" \t\n") == 0


def test_simhash_of_nothing(documents):
    assert simhash.groups(documents([])).count() == 0
