import random
import zlib

import numpy as np
import pytest

from tsforge.llm import quality

ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "a b c " * 5000, None), (5, "a b c " * 5000, None)]


def sample(rng, n):
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 9))) for _ in range(rng.randrange(20, 200))]
        yield (100 + i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words), "s"), int(good)


@pytest.fixture(scope="module")
def rows():
    return list(sample(random.Random(1), 400))


def test_held_out_accuracy_and_contract(spark, documents, rows):
    docs = documents(ODD + [r for r, _ in rows], extra=True)
    labels = spark.createDataFrame([(r[0], y, 0) for r, y in rows] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    stats = quality.described(docs)
    found = quality.score(stats, quality.fit(stats, labels)).collect()
    assert len(found) == len(rows) + len(ODD)
    truth = {r[0]: y for r, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held) > 50
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_labels_teach_nothing(spark, documents, rows):
    docs = documents([r for r, _ in rows])
    stats = quality.described(docs)
    models = []
    for flip in (False, True):
        labels = spark.createDataFrame([(r[0], 1 - y if flip and zlib.crc32(str(r[0]).encode()) % 3 == 1 else y) for r, y in rows], "doc_id long, quality int")
        models.append(quality.fit(stats, labels).weights)
    assert np.array_equal(*models)


def test_normal_equations_equal_a_direct_fit(spark, documents, rows):
    docs = documents([r for r, _ in rows])
    stats = quality.described(docs)
    model = quality.fit(stats, spark.createDataFrame([(r[0], y) for r, y in rows], "doc_id long, quality int"))
    train = [(r, y) for r, y in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    z = model.features(np.array([quality.statistics(r[1]) for r, _ in train], np.float32).astype(float))
    y = np.array([y for _, y in train], float)
    assert np.allclose(model.weights, quality.solve(z.T @ z, z.T @ y, len(y)), atol=1e-6)


def test_kernel_is_approximated():
    rng = np.random.default_rng(1)
    model = quality.Model(np.zeros(quality.WIDTH), np.ones(quality.WIDTH))
    x = rng.normal(size=(30, quality.WIDTH)) * 0.5
    z = model.features(x)[:, 1:]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.SCALE**2))
    assert abs(z @ z.T - exact).max() < 0.35 and abs(z @ z.T - exact).mean() < 0.08


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(2)
    s, n = np.sort(rng.random(40)), rng.integers(1, 9, 40).astype(float)
    p = np.minimum(n, rng.integers(0, 9, 40)).astype(float)
    knots, values = quality.isotonic(s, p, n)
    assert (np.diff(values) > 0).all()
    # the min-max formula of isotonic regression
    share = lambda a, b: p[a : b + 1].sum() / n[a : b + 1].sum()
    want = [max(min(share(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(values, 9))


def test_no_labels_and_no_rows(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    stats = quality.described(documents(ODD))
    assert {r.score for r in quality.score(stats, quality.fit(stats, labels)).collect()} == {0.5}
    one = spark.createDataFrame([(5, 1)], "doc_id long, quality int")
    assert quality.accepted(documents(ODD), quality.fit(stats, one)).count() == len(ODD)
    none = quality.described(documents([]))
    assert quality.score(none, quality.fit(none, labels)).count() == 0
