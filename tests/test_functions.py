import fnmatch
import json
import random
import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tsforge import schema
from tsforge.functions import globs, identity, times


def test_days_and_texts_of_times(spark):
    values = [0, -1, 86_400 * 10**9 - 1, -86_400 * 10**9, 1_735_689_600_028_420_265, -1_000_000_001]
    df = spark.createDataFrame([(v,) for v in values], "t long")
    rows = df.select("t", times.date_of(F.col("t")).alias("d"), times.rfc3339(F.col("t")).alias("s"), times.parse_rfc3339(times.rfc3339(F.col("t"))).alias("p")).collect()
    for r in rows:
        whole, rest = divmod(r.t, 10**9)
        moment = datetime(1970, 1, 1, tzinfo=UTC).fromtimestamp(whole, UTC)
        assert r.d == moment.date() and r.p == r.t
        assert r.s == moment.strftime("%Y-%m-%dT%H:%M:%S") + f".{rest:09d}Z"
    odd = spark.createDataFrame([("2025-01-01T00:00:00.5Z",), ("2025-01-01T00:00:00Z",), ("2025-01-01",), ("2025-13-01T00:00:00Z",)], "s string")
    assert [r[0] for r in odd.select(times.parse_rfc3339(F.col("s"))).collect()] == [1_735_689_600_500_000_000, 1_735_689_600_000_000_000, None, None]


def test_unsigned_masks(spark):
    df = spark.createDataFrame([(0,), (63,)], "b int")
    masks = df.agg(F.bit_or(schema.bit("b")).alias("m"))
    assert masks.select(schema.unsigned("m")).first()[0] == 9223372036854775809


def test_globs_against_the_library(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab.[]!^-\n", k=rng.randrange(5))) for _ in range(60)]
    patterns = {"".join(rng.choices(["a", "b", "*", "?", "[ab]", "[!a]", "[a-b]", "[b-a]", "[!b-a]", "[!", "]", "-", ".", "^", "[", "\\"], k=rng.randrange(1, 5))) for _ in range(150)}
    for p in patterns:
        ours = re.compile(globs.to_regex(p).replace(r"\z", r"\Z"))
        assert [bool(ours.match(t)) for t in texts] == [fnmatch.fnmatchcase(t, p) for t in texts], p
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in sorted(patterns)[:25]:
        got = {r.t for r in df.filter(globs.matches(F.col("t"), p)).collect()}
        assert got == {t for t in texts if fnmatch.fnmatchcase(t, p)}, p


# Published ids: (vsn, sensor, digest) of instruments in the zone "core".
PUBLISHED = [("W08D", "vaisala-wxt536", "934c67f6166a"), ("W08D", "vaisala-aqt530", "df6b0090a23b"), ("W039", "vaisala-aqt530", "5b8d3ce9a8bc"), ("W069", "vaisala-aqt530", "7d3281693666"), ("W099", "vaisala-aqt530", "94b6cd87b5de"), ("W0A4", "vaisala-aqt530", "15eaee7f9137")]


def test_published_identities(spark):
    df = spark.createDataFrame([("wxt.env.temp", {"vsn": v, "sensor": s, "zone": "core", "node": "x"}) for v, s, _ in PUBLISHED], "m string, tags map<string,string>")
    rows = df.select(identity.instrument(F.col("m"), F.col("tags")).alias("i")).collect()
    assert [r.i.instrument_id for r in rows] == [f"{v}--{s}--core--{d}" for v, s, d in PUBLISHED]
    assert {r.i.confidence for r in rows} == {"high"} and {r.i.source for r in rows} == {"vsn+sensor"}


def test_series_ids(spark):
    rows = [("wxt.env.temp", {"vsn": "W08E", "sensor": "vaisala-wxt536", "node": "n"}), ("wxt.env.temp", {"sensor": "é", "vsn": "W08E"}), ('q"\\', {"a": "tab\t", "b": "\x01"})]
    df = spark.createDataFrame(rows, "measurement string, tags map<string,string>")
    got = [bytes(r.series_id).hex() for r in identity.with_series_id(df).collect()]
    assert sorted(got) == sorted([identity.python_series_id(*r) for r in rows])
    assert "fde9d67d5373c76619c33cca4032d4fb" in got and "3175cfbfd6182be306487b4f530a97de" in got


def test_registry(spark):
    registry = identity.Registry.from_document({"rules": [{"instrument_id": "a", "match": {"vsn": "W1", "sensor": "s"}}, {"instrument_id": "b", "match": {"vsn": "W1"}}]})
    df = spark.createDataFrame([("m", {"vsn": "W1", "sensor": "s"}), ("m", {"vsn": "W1"}), ("sys.load", {"vsn": ""}), ("x.y", {"task": "cam era!", "vsn": "W2", "device": "D 1"})], "m string, tags map<string,string>")
    found = [r[0] for r in df.select(identity.instrument(F.col("m"), F.col("tags"), registry)).collect()]
    assert [f.instrument_id for f in found[:2]] == ["a", "b"] and found[0].source == "registry"
    assert found[2].kind == "system" and found[2].confidence == "low" and found[2].vsn == "unknown-vsn"
    assert found[3].instrument_id.startswith("W2--cam-era--unknown-zone--d-1--") and found[3].confidence == "medium" and found[3].review_required
    for bad in ({"rules": [{"instrument_id": "a", "match": {"node": "x"}}]}, {"rules": {}}, {"rules": [{"instrument_id": "a", "match": {}}]}):
        with pytest.raises(ValueError):
            identity.Registry.from_document(bad)
    with pytest.raises(Exception, match="not in the registry"):
        df.select(identity.instrument(F.col("m"), F.col("tags"), identity.Registry(registry.rules, True))).collect()


def test_periods():
    at = lambda *x: datetime(*x, tzinfo=UTC)
    ids = [p.id for p in times.iter_periods(at(2025, 1, 1, 0, 30), at(2025, 1, 1, 2), "1h")]
    assert ids == ["20250101T003000Z_20250101T010000Z", "20250101T010000Z_20250101T020000Z"]
    assert [p.start.month for p in times.iter_periods(at(2024, 11, 15), at(2025, 2, 3), "1month")] == [11, 12, 1, 2]
    assert [(p.start.year, p.end.year) for p in times.iter_periods(at(2023, 5, 1), at(2025, 1, 1), "1year")] == [(2023, 2024), (2024, 2025)]
    assert len(list(times.iter_periods(at(2024, 2, 28), at(2024, 3, 1), "1d"))) == 2
    assert len(list(times.iter_periods(at(2024, 2, 28), at(2024, 3, 1), "all"))) == 1
    assert times.Period(at(2025, 1, 1, 0, 0, 0, 5), at(2025, 1, 2)).id == "20250101T000000.000005Z_20250102T000000Z"
    with pytest.raises(ValueError):
        list(times.iter_periods(at(2025, 1, 2), at(2025, 1, 2), "1d"))
    with pytest.raises(ValueError):
        list(times.iter_periods(datetime(2025, 1, 1), at(2025, 1, 2), "1d"))
    assert len(times.dates_between(at(2025, 1, 1), at(2025, 1, 3))) == 2
    assert times.iso_duration(1_500_000_000) == "PT1.5S" and times.iso_duration(0) == "PT0S"


@pytest.mark.parametrize("period", times.PERIODS)
def test_periods_of_columns_are_those_of_the_list(spark, period):
    start, end = datetime(1969, 11, 28, 22, 30, tzinfo=UTC), datetime(1972, 3, 1, 0, 0, 0, 7, tzinfo=UTC)
    listed = list(times.iter_periods(start, end, period))
    first, past = times.to_ns(start), times.to_ns(end)
    edges = sorted({e for p in listed for e in p.bounds})
    moments = sorted({m for e in edges[:: max(1, len(edges) // 200)] for m in (e - 1, e, e + 1)} | {first - 1, first, past - 1, past})
    df = spark.createDataFrame([(m,) for m in moments], "t long")
    p = times.period_of(F.col("t"), start, end, period)
    for r in df.select("t", p.alias("p"), times.period_id(p["start"], p["end"]).alias("id")).collect():
        want = next((x for x in listed if x.bounds[0] <= r.t < x.bounds[1]), None)
        assert (r.p and tuple(r.p), r.id) == ((want.bounds, want.id) if want else (None, None)), r
    assert [a.end for a in listed[:-1]] == [b.start for b in listed[1:]] and (listed[0].start, listed[-1].end) == (start, end)


def test_json_quoting(spark):
    texts = ['a"b', "back\\slash", "line\n", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(identity.quoted(F.col("t"))).collect()] == [json.dumps(t) for t in texts]
