"""The pipeline against a brute-force version of each stage."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from tsforge.llm import bpe, mixing, quality
from tsforge.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        out.append((docs, after))
        docs = after
    return [(a.collect(), b.collect(), a.columns, b.columns) for a, b in out]


def test_columns(stages):
    for before, after, was, now in stages[:-1]:
        assert was == now and before and after


def test_quality_stage(spark, stages):
    before, after, *_ = stages[0]
    docs = table(spark, SF, "documents")
    stats = quality.described(docs)
    model = quality.fit(stats, table(spark, SF, "labels"))
    import numpy as np

    scores = model.scores(quality.measured([r.text for r in before]).astype(np.float64))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, s in zip(before, scores) if s >= 0.5)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after}
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)


def test_exact_stage(stages):
    before, after, *_ = stages[1]
    last = {}
    for r in before:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert sorted(r.doc_id for r in after) == sorted(last.values())


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    size = max(1, min(5, len(words)))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def test_near_stage(stages):
    """Every pair of texts by its own 5-word shingles, at a similarity of 0.8 or more."""
    before, after, *_ = stages[2]
    sets = {r.doc_id: shingles(r.text) for r in before}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert sorted(r.doc_id for r in after) == sorted({find(d) for d in sets})


def test_mix_stage(stages):
    before, after, *_ = stages[3]
    size = lambda t: len(t.encode().split())
    sums, taken, longest = Counter(), Counter(), Counter()
    for r in before:
        sums[r.source] += size(r.text)
        longest[r.source] = max(longest[r.source], size(r.text))
    for r in after:
        taken[r.source] += size(r.text)
    order = sorted(sums)
    goal = dict(zip(order, mixing.targets([sums[s] for s in order])))
    assert all(abs(taken[s] - round(goal[s])) <= longest[s] / 2 for s in order)
    assert {r.text for r in after} <= {r.text for r in before}  # whole documents


def test_token_stage(stages):
    before, after, *_ = stages[4]
    codec = bpe.Codec()
    want = Counter((r.doc_id, hashlib.sha256(" ".join(map(str, codec.ids(r.text).tolist())).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in before)
    assert Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in after) == want


def test_run_is_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, stages[-1][1]))


ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "a b c " * 9000, None), (5, "a b c " * 9000, None), (6, "one, two three.", "é"), (7, "one, two three.", "t")]


@pytest.mark.parametrize("number", range(5))
@pytest.mark.parametrize("rows", [ODD, []])
def test_each_stage_takes_odd_rows_and_extra_columns(spark, documents, number, rows):
    docs = documents(rows, extra=True)
    out = corpus_pipeline.STAGES[number][1](spark, docs, SF)
    if number < 4:
        assert out.columns == docs.columns
        assert all(r["_id"] == r["row"] == r["salt"] == "x" for r in out.collect())
    else:
        assert out.count() == len(rows)
    if number == 1:
        assert sorted((r.text or "") for r in out.collect()) == sorted({t or "" for _, t, _ in rows})
