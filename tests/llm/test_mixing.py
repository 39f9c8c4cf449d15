import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tsforge.llm import mixing

ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "a b\tc " * 5000, None), (5, "a b\tc " * 5000, None), (6, " x\n", "é"), (7, "  y", "Z")]


def test_targets():
    assert mixing.targets([10, 10, 10], (1, 2, 3)) == [5, 10, 15]
    assert mixing.targets([100, 0, 2], (1, 2, 3)) == [96, 0, 6]
    assert mixing.targets([]) == []
    # the first round caps one source, and its excess lifts another above its cap
    found = mixing.targets([60, 12, 3], (1, 2, 3))
    assert found == [30, 36, 9] and sum(found) == 75


@pytest.mark.parametrize("shards", [1, 2, 7])
def test_split_is_exact(shards):
    counts = np.array([1000, 0, 17, 5000, 3])
    quotas = mixing.split(counts, shards)
    assert (quotas.sum(axis=0) == counts).all() and (quotas >= 0).all()
    assert quotas.sum(axis=1).max() - quotas.sum(axis=1).min() <= shards
    assert (mixing.split(counts, shards) == quotas).all()


def test_draws_beyond_the_library_are_exact_in_sum():
    counts = np.array([3 * 10**9, 10**9, 5])
    quotas = mixing.split(counts, 4)
    assert (quotas.sum(axis=0) == counts).all() and (quotas >= 0).all()


@pytest.mark.parametrize("good,bad,n", [(7, 5, 6), (1, 1, 1), (30, 4, 20), (3, 200, 50), (200, 3, 199), (40, 40, 1)])
def test_draws_have_the_distribution(good, bad, n):
    """Against probabilities by binomials, and all that may come does."""
    rng, times = np.random.default_rng(5), 20_000
    drawn = Counter(mixing.hypergeometric(rng, good, bad, n) for _ in range(times))
    for k in range(min(n, good) + 1):
        p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) if n - k <= bad else 0
        assert abs(drawn[k] / times - p) < 5 * (p / times) ** 0.5 + 1e-3
        assert p or not drawn[k]


def test_large_draws_have_mean_and_spread():
    rng, good, bad, n = np.random.default_rng(6), 3 * 10**11, 7 * 10**11, 4 * 10**11
    drawn = np.array([mixing.hypergeometric(rng, good, bad, n) for _ in range(200)], float)
    share, total = good / (good + bad), good + bad
    spread = (n * share * (1 - share) * (total - n) / (total - 1)) ** 0.5
    assert abs(drawn.mean() - n * share) < 5 * spread / 200**0.5 and 0.8 < drawn.std() / spread < 1.2


def corpus(rng):
    return ODD + [(100 + i, " ".join("w" for _ in range(rng.randrange(40))), rng.choice("aaaaaaaabcd")) for i in range(400)]


def by_hand(sizes):
    """Targets of words by weights 1, 2, 3 and a limit of three times, by water filling in fractions."""
    total, goal, left = Fraction(sum(sizes)), {}, list(range(len(sizes)))
    while left:
        unit = total / sum(i % 3 + 1 for i in left)
        full = [i for i in left if (i % 3 + 1) * unit > 3 * sizes[i]]
        goal |= {i: Fraction(3 * sizes[i]) for i in full} or {i: (i % 3 + 1) * unit for i in left}
        total -= sum(goal[i] for i in full)
        left = [i for i in left if i not in goal]
    return [float(goal[i]) for i in range(len(sizes))]


@pytest.mark.parametrize("bucket,run", [(mixing.BUCKET, mixing.RUN), (8, 3)])
def test_taken_against_brute_force(documents, monkeypatch, bucket, run):
    monkeypatch.setattr(mixing, "RUN", run)
    rows = corpus(random.Random(3))
    mix = mixing.Mix(documents(rows, extra=True), bucket=bucket)
    found = mix.taken().collect()
    assert len(found) == len(rows)
    size = lambda t: len((t or "").encode().split())
    sums, longest = Counter(), Counter()
    for _, t, s in rows:
        sums[s] += size(t)
        longest[s] = max(longest[s], size(t))
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, by_hand([sums[s] for s in order])))
    taken = Counter()
    for r in found:
        assert r.source_size == sums[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken in {k * r.size for k in range(4)}  # whole documents
        taken[r.source] += r.taken
    for s in order:  # no document more or less comes nearer
        assert abs(taken[s] - round(goal[s])) <= longest[s] / 2
    assert Counter((r.doc_id, r.size, r.taken) for r in found) == Counter((r.doc_id, r.size, r.taken) for r in mixing.Mix(documents(rows[::-1], extra=True), bucket=bucket).taken().collect())


def test_what_is_taken_comes_from_the_tree(documents, monkeypatch):
    mix = mixing.Mix(documents(corpus(random.Random(3))), shards=3)
    monkeypatch.setattr(mixing, "split", lambda counts, shards, seed: np.zeros((shards, len(counts)), np.int64))
    assert {r.taken for r in mix.taken().collect()} == {0}


def test_rows_that_differ_in_another_column(spark):
    rows = [(1, "a b", "en", "s", i) for i in range(6)] + [(1, "a b", "en", "s", 0)] * 2 + [(9, "w " * 40, "en", "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mix = mixing.Mix(docs)
    out = Counter((r.doc_id, r.n_chars) for r in mix.documents().collect())
    # 16 words, of which the mix takes 19: each row once, and two of them again (20 and 18 are as near)
    assert {k for k in out if k[0] == 1} == {(1, i) for i in range(6)} and out[1, 0] >= 3 and sum(out.values()) - out[9, 1] == 10


def test_shards_hold_disjoint_ranks(documents):
    mix = mixing.Mix(documents(corpus(random.Random(4))), shards=5, bucket=16)
    draws = mix.dealt().collect()
    by = defaultdict(list)
    for d in draws:
        by[d.source, d["pass"]].append((d["rank"], d.shard))
    for ranks in by.values():
        assert [r for r, _ in sorted(ranks)] == list(range(len(ranks)))  # the first ranks, whole
        assert [s for _, s in sorted(ranks)] == sorted(s for _, s in ranks)
    sizes = Counter(d.shard for d in draws)
    assert len(sizes) == 5 and max(sizes.values()) - min(sizes.values()) <= 5


def test_mixed_documents(documents):
    rows = corpus(random.Random(5))
    docs = documents(rows, extra=True)
    mix = mixing.Mix(docs)
    out = mix.documents()
    assert out.columns == docs.columns
    mixed = out.collect()
    words, whole = Counter(), {t for _, t, _ in rows}
    for r in mixed:
        words[r.source] += len((r.text or "").encode().split())
        assert r.n_chars == len(r.text) and r.text in whole
    taken = Counter()
    for r in mix.taken().collect():
        taken[r.source] += r.taken
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_mix_of_nothing(documents):
    mix = mixing.Mix(documents([]))
    assert mix.taken().count() == 0 and mix.documents().count() == 0
    empty = mixing.Mix(documents(["", None, " \t"]))
    assert [r.taken for r in empty.taken().collect()] == [0, 0, 0] and empty.documents().count() == 0


@pytest.mark.parametrize("n", [1, 7, 51, 211])
def test_numbers_are_dealt_exactly(spark, n):
    from pyspark.sql import functions as F

    from tsforge.llm.common import deal_exactly

    rows = deal_exactly(spark.range(0, 5 * n).withColumn("k", F.col("id") % n), F.col("k"), n).select("k", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(rows) == n and sorted(r.k for r in rows) == sorted(r.p for r in rows) == list(range(n))
