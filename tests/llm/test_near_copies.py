import random

import numpy as np
import pyarrow as pa
import pytest

from tsforge.llm import near_copies, simhash


def shingle_set(text):
    words = text.encode().translate(simhash._LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets, root = [shingle_set(t or "") for _, t, _ in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted((r[0], r[1]) for i, r in enumerate(rows) if r[0] == least[find(i)])


@pytest.mark.parametrize("chunk", [near_copies.CHUNK, 7])
def test_near_copies_at_similarity_of_four_fifths(documents, chunk):
    rng = random.Random(8)
    texts = ["", " \t", "One two", "one TWO", "one two three"]
    for n in (60, 248, 900):
        base = [f"w{rng.randrange(9000)}" for _ in range(n)]
        for edits in (1, 2, 4, 6, 9, 12, 20, 25):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(n)] = f"x{rng.randrange(9000)}"
            texts.append(" ".join(words))
    rows = [(100 + i, t, "s") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    out = near_copies.representatives(documents(rows, extra=True), chunk)
    found = sorted((r.doc_id, r.text) for r in out.collect())
    assert found == brute(rows) and len(found) < len(rows) - 8


def test_a_large_group_and_what_only_shares_a_key_with_it(documents, monkeypatch):
    """One key for all texts: classes that are not similar to the hub are compared with each other, and with the largest."""


    def one_key(batches):
        for batch in batches:
            keys = pa.array([[7]] * batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "mark", "digest")), keys], names=["doc_id", "mark", "digest", "keys"])

    monkeypatch.setattr(near_copies, "_keys", one_key)
    rng = random.Random(9)
    base = [[f"w{rng.randrange(9000)}" for _ in range(100)] for _ in range(3)]
    rows = [(i, " ".join(b[:k] + [f"x{i}"] + b[k + 1 :]), "s") for i, (b, k) in enumerate((base[i % 3 if i > 60 else 0], rng.randrange(100)) for i in range(90))]
    rows += [(200 + i, " ".join(f"y{rng.randrange(9000)}" for _ in range(50)), "s") for i in range(10)]
    found = sorted((r.doc_id, r.text) for r in near_copies.representatives(documents(rows), 16).collect())
    assert found == brute(rows) and len(found) < 20


def test_the_stage_takes_out_a_pair_that_simhash_leaves(spark, documents):
    import corpus_pipeline

    words = [f"w{i}" for i in range(248)]
    pair = [" ".join(words), " ".join(w if i not in (50, 150, 200) else "x" for i, w in enumerate(words))]
    assert (simhash.fingerprint(pair[0].encode()) ^ simhash.fingerprint(pair[1].encode())).bit_count() > simhash.DISTANCE
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, documents(pair), "").collect()] == [0]


def test_the_stage_goes_by_simhash_fingerprints(spark, documents, monkeypatch):
    """A bit is the majority of the shingles' hashes; near copies whose fingerprints share no block don't meet."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 4, 15, 16, 1275, 1276, 3000):
        found = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        hashes = found[:, None] * near_copies._FACTORS
        bits = np.unpackbits((hashes ^ hashes >> np.uint64(32)).view(np.uint8), axis=1, bitorder="little")
        want = bits.sum(axis=0, dtype=np.int64) * 2 > n
        assert np.array_equal(np.unpackbits(near_copies.fingerprint(found).view(np.uint8), bitorder="little"), want)
    words = [f"w{i}" for i in range(100)]
    docs = documents([" ".join(words), " ".join(words[:-1])])
    assert near_copies.representatives(docs).count() == 1
    monkeypatch.setattr(near_copies, "fingerprint", lambda found: np.full(near_copies.WORDS, len(found) * 0x0001000100010001, np.uint64))
    near = near_copies._keys([pa.RecordBatch.from_pylist([{"doc_id": i, "mark": i, "digest": b"", "text": t} for i, t in enumerate([" ".join(words), " ".join(words[:-1])])])])
    blocks = near_copies._blocks(near, 1, near_copies.Plan.of(2))
    assert list(near_copies._groups(blocks)) == []


def test_pairs_at_four_fifths_share_blocks():
    """The sizes at which most bits differ: by calculation 5 in 100,000 pairs of the first share no block, fewer of the others."""
    rng = np.random.default_rng(4)
    for both, a, b in ((12, 0, 3), (20, 2, 3), (80, 10, 10)):
        for _ in range(200):
            s = rng.integers(0, 1 << 64, both + a + b, dtype=np.uint64)
            x, y = near_copies.fingerprint(s[: both + a]), near_copies.fingerprint(np.r_[s[:both], s[both + a :]])
            keys = near_copies.Plan.of(1).of_words(np.stack([x, y]))
            assert ((keys[0] == keys[1]) == (x.view("<u2") == y.view("<u2"))).all()  # the fingerprint cut as it is
            assert (keys[0] == keys[1]).any() and np.bitwise_count(x[:3] ^ y[:3]).sum() <= near_copies.DISTANCE
            longer = near_copies.Plan.of(32 << 21).of_words(np.stack([x, y]))
            assert (longer[0] == longer[1]).any()


def test_four_shingles_of_five(documents, monkeypatch):
    """Such pairs are found without their fingerprints."""
    monkeypatch.setattr(near_copies, "_blocks", lambda batches, n, plan: iter(()))
    rows = []
    for i in range(40):
        words = [f"w{i}x{j}" for j in range(9)]
        rows += [(10 * i, " ".join(words), "s"), (10 * i + 1, " ".join(words[i % 2 :][:8]), "s"), (10 * i + 2, " ".join(words[:7]), "s")]
    found = sorted((r.doc_id, r.text) for r in near_copies.representatives(documents(rows)).collect())
    assert found == brute(rows) and len(found) == 80


def test_groups_are_what_links_connect():
    rng = np.random.default_rng(5)
    rows = np.zeros(700, near_copies._AT)
    rows["key"], rows["mark"] = np.sort(np.r_[np.full(300, 7), rng.integers(10, 90, 400)]), rng.permutation(700)
    base = rng.integers(0, 1 << 64, (8, near_copies.COMPARED), dtype=np.uint64)
    for i, r in enumerate(rng.integers(0, 8, 700)):
        flips = [sum(1 << int(b) for b in set(rng.integers(0, 64, 11))) for _ in range(near_copies.COMPARED)]
        rows["words"][i] = base[r] ^ np.array(flips, np.uint64)
    root = list(range(700))
    for i in range(700):
        for j in range(i):
            if rows["key"][i] == rows["key"][j] and near_copies._apart(rows[i], rows[j]) <= near_copies.DISTANCE and root[i] != root[j]:
                root = [root[i] if x == root[j] else x for x in root]
    want = {}
    for i, x in enumerate(root):
        want.setdefault(x, []).append(int(rows["mark"][i]))
    shuffled = rng.permutation(rows)
    batch = pa.RecordBatch.from_pydict({"task": [0, 0], "rows": [shuffled[:100].tobytes(), shuffled[100:].tobytes()]})
    got = {}
    for out in near_copies._groups([batch]):
        for r in out.to_pylist():
            got.setdefault((r["key"], r["hub"], r["m"]), []).append(r["mark"])
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)
    assert all(hub == min(g) and m == len(g) for (_, hub, m), g in got.items())
    assert list(near_copies._groups([])) == []


@pytest.mark.parametrize("largest", [None, 50])
def test_a_text_of_many_keys_is_compared_in_one_group(documents, monkeypatch, largest):
    """Versions of one text that are half similar or more meet at most of their keys; all pairs are found, in few rows for a text."""
    dealt, real = [], near_copies._dealt
    monkeypatch.setattr(near_copies, "_dealt", lambda rows, *order: dealt.append(rows.count()) or real(rows, *order))
    if largest:  # or a group that is compared key by key
        monkeypatch.setattr(near_copies, "_patience", lambda plan, chunk: largest)
    rng = random.Random(12)
    base = [f"w{rng.randrange(9000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.randrange(3, 11) if i % 8 else 1):
            words[rng.randrange(150)] = f"x{rng.randrange(9000)}"
        rows.append((i, " ".join(words), "s"))
    found = sorted((r.doc_id, r.text) for r in near_copies.representatives(documents(rows), 64).collect())
    assert found == brute(rows) and 50 < len(found) < 390
    assert sum(dealt) < 20 * len(rows) or largest == 50


def test_what_a_text_meets_by_chance_does_not_grow_with_the_corpus(monkeypatch):
    """Pairs at one key, of texts that have nothing in common, for 1,600 to 25,600 texts; with keys of 6 bits as the shortest."""
    monkeypatch.setattr(near_copies, "BITS", 6)
    rng = np.random.default_rng(6)
    pairs, keys = [], []
    for n in (1_600, 6_400, 25_600):
        plan = near_copies.Plan.of(n)
        found = np.sort(plan.of_words(rng.integers(0, 1 << 64, (n, near_copies.WORDS), dtype=np.uint64)), axis=0)
        each = 0
        for column in found.T:
            counts = np.unique(column, return_counts=True)[1]
            each += int((counts * (counts - 1) // 2).sum())
        pairs.append(each / n / plan.keys)
        keys.append(plan.keys)
    assert max(pairs) <= near_copies.CHANCE / 2 * 1.1 and max(pairs) < 1.2 * min(pairs)  # at each key; the corpus grew sixteenfold
    assert keys[2] < 16**0.3 * keys[0] and near_copies.Plan.of(10**8).keys < 500


def test_texts_that_share_a_hash_are_an_error(documents, monkeypatch):
    monkeypatch.setattr(near_copies.F, "xxhash64", lambda c: near_copies.F.lit(7).cast("long"))
    with pytest.raises(Exception, match="share a hash"):
        near_copies.representatives(documents(["a b c", "d e f"])).count()


def test_recall_on_all_pairs_of_a_table(spark):
    """Every pair of the texts of sf0.1 at 0.8 or more, found by prefixes of rare shingles, is linked."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").dropDuplicates(["text"])
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    sets = {d: shingle_set(t or "") for d, t in texts.items()}
    often = {}
    for s in sets.values():
        for x in s:
            often[x] = often.get(x, 0) + 1
    by_rare, pairs = {}, set()
    for d, s in sets.items():
        own = sorted(s, key=lambda x: (often[x], x))
        for x in own[: len(own) - -(-4 * len(own) // 5) + 1]:
            for other in by_rare.setdefault(x, []):
                both = len(s & sets[other])
                if 5 * both >= 4 * (len(s) + len(sets[other]) - both):
                    pairs.add((other, d))
            by_rare[x].append(d)
    marked = near_copies._marked(docs)
    distinct = marked.mapInArrow(near_copies._keys, "doc_id long, mark long, digest binary, keys array<long>").select("mark", "keys")
    roots = {r.node: r.root for r in simhash.components(near_copies.links(docs, distinct)).collect()}
    mark = {r.doc_id: r.mark for r in docs.select("doc_id", F.xxhash64("text").alias("mark")).collect()}
    linked = sum(mark[a] in roots and roots[mark[a]] == roots.get(mark[b]) for a, b in pairs)
    assert len(pairs) > 30 and linked == len(pairs)
