"""Many selectors, many rules, many ranges: against what asks each of them."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from tsforge.functions.globs import is_glob
from tsforge.functions.identity import Registry, Rule
from tsforge.operators import ingest, many_selectors, ranges, registry
from tsforge.operators.selection import Selection


def glob(rng, letters="abc."):
    return "".join(rng.choices([*letters, "*", "?", "[ab]", "[!a]", "[a-b]", "[", "]", "!"], [6] * len(letters) + [2, 2, 1, 1, 1, 1, 1, 1], k=rng.randrange(1, 7)))


@pytest.mark.parametrize("seed", range(20))
def test_an_automaton_equals_the_library(seed):
    rng = random.Random(seed)
    patterns = sorted({p for _ in range(200) if is_glob(p := glob(rng))})
    automaton = many_selectors.Automaton(patterns)
    for _ in range(300):
        text = "".join(rng.choices("abc.[]!\n", k=rng.randrange(8)))
        assert sorted(automaton.matches(text)) == sorted(p for p in patterns if fnmatch.fnmatchcase(text, p)), text


def test_few_states_are_forgotten_without_loss(monkeypatch):
    monkeypatch.setattr(many_selectors, "KEPT", 5)
    rng = random.Random(1)
    patterns = sorted({p for _ in range(60) if is_glob(p := glob(rng))})
    automaton = many_selectors.Automaton(patterns)
    for _ in range(200):
        text = "".join(rng.choices("abc.", k=rng.randrange(8)))
        assert sorted(automaton.matches(text)) == sorted(p for p in patterns if fnmatch.fnmatchcase(text, p))


def selection(rng, n):
    out = []
    for i in range(n):
        s = {"measurement": f"m{i}.{rng.choice('abc')}"} if rng.random() < 0.6 else {"measurement_glob": f"m{i if n > 1000 else i % 97}{rng.choice(['?.b', '.[ab]', '*'] if n < 1000 else ['.[ab]', '.?'])}"}
        if rng.random() < 0.5:
            s["fields"] = [rng.choice(["value", "v*", "?ther", "x"]), rng.choice(["value", "other"])]
        if rng.random() < 0.6:
            s["tags"] = {k: [rng.choice(["W1", "W2", "W?", "*3", "[!W]*"])] for k in rng.sample(["vsn", "sensor", "zone"], rng.choice([1, 2]))}
        out.append(s)
    return Selection.from_document({"selection_version": 2, "selectors": out})


def test_ten_thousand_selectors(spark):
    rng = random.Random(4)
    many = selection(rng, 10_000)
    rows = [(f"m{rng.randrange(12_000 if i % 2 else 97)}.{rng.choice('abcd')}", rng.choice(["value", "other", "vx", "y"]), {k: rng.choice(["W1", "W2", "W3", "x3", ""]) for k in rng.sample(["vsn", "sensor", "zone", "node"], rng.randrange(5))}, i % 10) for i in range(1500)]
    points = spark.createDataFrame(rows, "measurement string, field string, tags map<string,string>, time_ns long")
    found = many_selectors.answered(points, many)
    assert found.count() == len(rows)
    few = [Selection.from_document({"selection_version": 2, "selectors": many.selectors[i : i + 60]}) for i in range(0, len(many.selectors), 60)]
    taken = 0
    for r in found.collect():
        want = any(s.takes(r.measurement, r.field, dict(r.tags)) for s in few)
        assert r._takes == want == many.takes(r.measurement, r.field, dict(r.tags)) and (r._candidate or not want)
        taken += want
    assert 100 < taken < 1400
    size = lambda s: len(many_selectors.answered(points, s)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(many) - size(selection(rng, 70))) < 200


def test_the_fate_of_points_does_not_depend_on_how_selectors_are_asked(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(f"m{rng.randrange(40)}.{rng.choice('abc')}", rng.choice(["value", "other"]), {k: rng.choice(["W1", "W2", "x3"]) for k in rng.sample(["vsn", "sensor", "zone"], rng.randrange(4))}, i) for i in range(400)]
    points = ingest.identified(spark.createDataFrame(rows, "measurement string, field string, tags map<string,string>, time_ns long"))
    wanted = selection(rng, 60)
    fate = lambda: sorted((r.time_ns, r.disposition) for r in ingest.classify(points, 0, 380, wanted).collect())
    inline = fate()
    assert len({d for _, d in inline}) >= 4
    monkeypatch.setattr(many_selectors, "INLINE", 3)
    wanted = Selection(wanted.canonical)
    assert fate() == inline
    index = points.select("measurement", "field", "tags")
    asked = {r[0] for r in wanted.measurements(index).collect()}
    monkeypatch.setattr(many_selectors, "INLINE", 1000)
    assert asked == {r[0] for r in Selection(wanted.canonical).measurements(index).collect()}


def test_rules_of_any_number_are_one_join(spark, monkeypatch):
    rng = random.Random(2)
    draw = lambda: {k: f"{k}{rng.randrange(6)}" for k in rng.sample(["vsn", "sensor", "zone", "device"], rng.randrange(1, 4))}
    rules = Registry(tuple(Rule(f"id{i}", tuple(sorted(draw().items()))) for i in range(300)))
    rows = [("m.a", {**draw(), "node": "n"} if i % 9 else {}, i) for i in range(500)]
    points = spark.createDataFrame(rows, "measurement string, tags map<string,string>, time_ns long").withColumn("field", F.lit("f"))
    brute = lambda tags: next((r.instrument_id for r in rules.rules if all(tags.get(k) == v for k, v in r.match)), None)
    found = registry.with_listed(points, rules, ["time_ns"])
    assert found.columns == [*points.columns, "_listed"]
    got = {r.time_ns: r._listed for r in found.collect()}
    assert got == {i: brute(t) for _, t, i in rows} == {i: rules.find(t) for _, t, i in rows} and len(set(got.values())) > 30
    ids = lambda: sorted((r.time_ns, r.instrument_id, r.identity_source) for r in ingest.identified(points, rules).collect())
    rules = Registry(rules.rules[:40])
    inline = ids()
    monkeypatch.setattr(registry, "INLINE", 10)
    assert ids() == inline


def test_rules_without_tags_or_values_agree_with_nothing(spark):
    rules = spark.sql("select * from values (1L, 'a', map()), (2L, 'b', map('vsn', cast(null as string))), (3L, null, map('vsn', 'x')), (4L, 'd', map('vsn', 'x')), (5L, 'e', map('vsn', 'x')), (6L, 'f', map('node', 'n')) as t(number, instrument_id, match)")
    series = spark.sql("select * from values (1, map('vsn', 'x')), (2, map('vsn', 'y', 'node', 'n')), (3, map()), (4, null) as t(i, tags)")
    assert {r.i: r.listed for r in registry.listed(series, rules, ["i"]).collect()} == {1: "d", 2: None, 3: None, 4: None}
    assert registry.listed(series, rules.limit(0), ["i"]).filter("listed is not null").count() == 0


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_ranges_that_overlap_and_their_gaps(spark, width):
    rng = random.Random(width)
    draw = lambda n: [(i, rng.choice(["x", "y", None]), a, a + rng.choice([-1, 0, 1, 5, 40])) for i in range(n) for a in [rng.randrange(-300, 300)]]
    left, right = draw(150), draw(120)
    a = spark.createDataFrame(left, "i int, k string, low long, high long")
    b = spark.createDataFrame(right, "j int, k string, low long, high long")
    pairs = lambda on: sorted((x[0], y[0], max(x[2], y[2]), min(x[3], y[3])) for x in left for y in right if (not on or x[1] == y[1] is not None) and x[2] < x[3] and y[2] < y[3] and max(x[2], y[2]) < min(x[3], y[3]))
    found = ranges.joined(a, b, width, ["k"])
    assert sorted((r.i, r.j, r.low, r.high) for r in found.collect()) == pairs(True)
    assert sorted((r.i, r.j, r.low, r.high) for r in ranges.joined(a, b.withColumnRenamed("k", "k2"), width).collect()) == pairs(False)
    want = []
    for key in ("x", "y", None):
        own, reach = sorted((r[2], r[3]) for r in left if r[1] == key and r[2] < r[3]), None
        for low, high in own:
            if reach is not None and low > reach:
                want.append((key, reach, low))
            reach = high if reach is None else max(reach, high)
    assert sorted(map(tuple, ranges.gaps(a, width, ["k"]).collect()), key=str) == sorted(want, key=str) and len(want) > 10
    assert ranges.gaps(a.limit(0), width).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
