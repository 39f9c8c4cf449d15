"""The filter audit against a loop over documents, orders and steps."""

import random
import re
from itertools import permutations

from tsforge.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def fails_of(rows):
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        flags = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > least[text],
        }
        out.append((source or "", {k for k, v in flags.items() if v}, doc_id))
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    docs, out, removals = fails_of(rows), [], {}
    for part in {p for p, _, _ in docs}:
        for order in permutations("ABCDE"):
            left = [(f, d) for p, f, d in docs if p == part]
            every = list(left)
            for step, name in enumerate(order, 1):
                gone = [(f, d) for f, d in left if name in f]
                left = [(f, d) for f, d in left if name not in f]
                failing = sum(name in f for f, _ in every)
                removals[part, name] = removals.get((part, name), 0) + len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(f == {name} for f, _ in every), sum(d in good for _, d in gone), sum(d in toxic for _, d in gone)])
    return sorted((*r, removals[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(spark, docs, labels):
    return sorted(tuple(r) for r in filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)).select(*COLUMNS).collect())


def test_steps_equal_a_loop(spark, documents):
    rng = random.Random(5)
    prose = [f"w{i}" for i in range(90)]
    texts = [" ".join(rng.sample(prose, rng.choice([3, 49, 50, 80]))) for _ in range(12)]
    texts += [" ".join(["again", "x"] * 40), "A B\tC\x0bD", "cost $5 #1", "", None, "a" * 95 + "ABCDE", "é" * 95 + "ABCDE", "x\x00y", "one" + " \t\n " * 9 + "two", "ÀÉ" * 30, "long " * 60_000]
    rows = [(i, rng.choice(texts), rng.choice(["s", "t", "", None])) for i in range(120)]
    rows += [(None, "", "s"), (None, "", None), (7, "twice", "t"), (7, "twice", "t"), (7, "twice", "s"), (8, "twice", "t"), (-3, "twice", "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 130, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (4, 1, 0)]
    assert found(spark, documents(rows, extra=True), labels) == brute(rows, labels)


def test_a_group_of_copies_over_all_parts(spark, documents):
    rows = [(i, "the same", f"p{i % 3}") for i in range(60)] + [(0, "the same", "p1"), (100, "other #", "p2")]
    assert found(spark, documents(rows), []) == brute(rows, [])


def test_no_documents_no_rows(spark, documents):
    assert found(spark, documents([]), [(1, 1, 1)]) == []
