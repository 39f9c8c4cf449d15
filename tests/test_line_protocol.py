import gzip
import io
import random

import pytest

from pyspark.sql import functions as F

from tsforge.functions.identity import Registry
from tsforge.operators import ingest
from tsforge.sources import line_protocol as lp
from tsforge.sources import tables

FULL = 'weather\\ station,node=n1,sensor=wxt\\ 536 temperature=2.5,count=-3i,total=4u,ready=true,message="first line\nsecond \\"line\\"" 123'


def slow_parse(text):
    """An independent parser, a character at a time."""
    def cut(s, mark, quotes):
        out, part, quoted, i = [], "", False, 0
        while i < len(s):
            c = s[i]
            if c == "\\" and i + 1 < len(s):
                part += s[i : i + 2]
                i += 2
                continue
            if c == '"' and quotes:
                quoted = not quoted
            if c == mark and not quoted:
                out.append(part)
                part = ""
            else:
                part += c
            i += 1
        if quoted:
            raise ValueError("open string")
        return [*out, part]

    def bare(s):
        out, i = "", 0
        while i < len(s):
            if s[i] == "\\" and i + 1 < len(s):
                i += 1
            out += s[i]
            i += 1
        return out

    first = cut(text, " ", False)[0]
    rest = text[len(first) + 1 :]
    at = rest.rindex(" ")
    name, *tags = cut(first, ",", False)
    tags = dict(map(bare, cut(t, "=", False)) for t in tags)
    fields = []
    for f in cut(rest[:at], ",", True):
        k, *v = cut(f, "=", False)
        v = "=".join(v)
        if v[0] == '"':
            value = ("string", v[1:-1].replace("\\\\", "\0").replace('\\"', '"').replace("\0", "\\"))
        elif v in ("true", "false"):
            value = ("bool", v == "true")
        elif v[-1] in "iu":
            value = ({"i": "int64", "u": "uint64"}[v[-1]], int(v[:-1]))
        else:
            value = ("float64", float(v))
        fields.append((bare(k), *value))
    return bare(name), tags, int(rest[at + 1 :]), fields


def test_types_escapes_and_lines():
    name, tags, t, fields = lp.parse_record(FULL)
    assert (name, tags, t) == ("weather station", {"node": "n1", "sensor": "wxt 536"}, 123)
    assert fields == [("temperature", "float64", 2.5), ("count", "int64", -3), ("total", "uint64", 4), ("ready", "bool", True), ("message", "string", 'first line\nsecond "line"')]


def test_against_the_slow_parser():
    rng = random.Random(1)
    key = lambda: "".join(rng.choice(["a", "b", "é", "\\ ", "\\,", "\\="]) for _ in range(rng.randrange(1, 5)))
    value = lambda: rng.choice(["1.5", "-2i", "7u", "true", '"x, y=1 \\" z"', '"line\nbreak"', "1e9", '""'])
    for _ in range(3000):
        tags = {key(): key() for _ in range(rng.randrange(4))}
        names = {k.replace("\\", "") for k in tags}
        if len(names) < len(tags):
            continue
        text = ",".join([key(), *(f"{k}={v}" for k, v in tags.items())]) + " " + ",".join(f"{key()}={value()}" for _ in range(rng.randrange(1, 4))) + f" {rng.randrange(-10**18, 10**18)}"
        want = slow_parse(text)
        assert lp.parse_record(text) == want, text
        rows = [r for b in lp.batches_of([text]) for r in b.to_pylist()]
        assert [(r["measurement"], dict(r["tags"]), r["time_ns"], r["field"], r["value_type"], r[f"value_{r['value_type']}"]) for r in rows] == [(*want[:3], *f) for f in want[3]]


@pytest.mark.parametrize("bad", ['m value="broken', "m value=9223372036854775808i 1", "m value=18446744073709551616u 1", "m value=-1u 1", "m v=1", "m", ",a=b v=1 1", "m,a=1,a=2 v=1 2", "m,a= v=1 2", "m v=1, 2", "m v= 1", "m =1 1", "m v=1d 1", "m v=1 x"])
def test_what_is_no_record(bad):
    with pytest.raises(lp.LineProtocolError):
        lp.parse_record(bad)
    with pytest.raises(lp.LineProtocolError):
        list(lp.batches_of([bad]))


def test_records_of_a_stream():
    data = b'# ignored\n\nm,t=a"b v=1 1\r\nm v="a\n#b\n" 2\n  \nm v=3 3'
    assert list(lp.records(data.splitlines(keepends=True))) == ['m,t=a"b v=1 1', 'm v="a\n#b\n" 2', "m v=3 3"]
    with pytest.raises(lp.LineProtocolError):
        list(lp.records([b'm v="a\n']))


def test_files_and_data_source(spark, tmp_path):
    (tmp_path / "a.lp").write_text(FULL + "\n# c\nm v=1 5\n")
    with gzip.open(tmp_path / "b.lp.gz", "wt") as f:
        f.write("m v=2,w=18446744073709551615u 6\n")
    lp.register(spark)
    want = None
    for df in (lp.read_files(spark, str(tmp_path)), spark.read.format("line_protocol").load(f"{tmp_path}/*")):
        rows = sorted((r.time_ns, r.field, r.value_type, r.value_float64, r.value_int64, r.value_uint64, r.value_bool, r.value_string, tuple(sorted(r.tags.items()))) for r in df.collect())
        assert len(rows) == 8 and want in (None, rows)
        want = rows
    assert max(r[5] or 0 for r in want) == 18446744073709551615


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
def test_splits_give_the_records_of_a_stream(spark, tmp_path, size):
    """Strings over many lines, with quotes and escapes, whatever the splits; a file's state never leaks into the next."""
    rng = random.Random(size)
    parts = ["x", " y=1", ",", "\\\"", "\n", "\n# no comment", "\r\n", "\\\\", "é", "   "]
    for name in ("a.lp", "b.lp"):
        with open(tmp_path / name, "w", newline="") as f:
            for i in range(120):
                text = "".join(rng.choices(parts, k=rng.randrange(1, 40)))
                quote = 't"' if rng.random() < 0.2 else "t"
                f.write(f'm,{quote}=a v="{text}",w={i}i {i}\n' if rng.random() < 0.6 else f"m,{quote}=a w={i}i {i}\n# \"c\n\n")
    want = sorted(r for name in ("a.lp", "b.lp") for r in lp.records(io.BytesIO((tmp_path / name).read_bytes())))
    with tables.settings(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}):
        found = sorted(r.record for r in lp.read_records(spark, str(tmp_path)).collect())
    assert found == want and len(want) == 240
    (tmp_path / "c.lp").write_text('m v="never ends 1\n')
    with pytest.raises(Exception, match="does not end|no string|not a"):
        lp.read_files(spark, str(tmp_path / "c.lp")).collect()


def test_identities_of_the_parser_are_those_of_columns(spark):
    rng = random.Random(4)
    registry = Registry.from_document({"rules": [{"instrument_id": "one", "match": {"vsn": "W1", "sensor": "a b"}}, {"instrument_id": "zone", "match": {"zone": "x"}}]})
    lines = set()
    for _ in range(300):
        tags = {k: rng.choice(["W1", "a b", "x", "--q--", "A/B.c", "long" * 40]).replace(" ", "\\ ") for k in ("vsn", "sensor", "zone", "task", "deviceName", "device", "node", "other") if rng.random() < 0.4}
        lines.add(",".join([rng.choice(["wxt.env.temp", "sys.x", "plain"]), *(f"{k}={v}" for k, v in tags.items())]) + " v=1 1")
    df = spark.createDataFrame([(x,) for x in sorted(lines)], "record string")
    columns = ["measurement", "series_id", "vsn", "sensor", "instrument_id", "identity_source"]
    text = lambda points: sorted(str(sorted(r.asDict().items())) for r in points.select(*columns, F.to_json(F.array_sort(F.map_entries("tags"))).alias("tags")).collect())
    for rules in (None, registry):
        assert text(ingest.identified(lp.decode(df), rules)) == text(ingest.identified(lp.decode_identified(df, registry=rules)))


def test_made_text_is_dealt_by_its_bytes(spark, monkeypatch):
    """Records that are made of a few packed rows are as many tasks as their bytes want."""
    made = spark.range(0, 900, 1, 1).selectExpr("concat('m,a=b f=\"', repeat('x', 1000), '\" ', id) record")
    assert lp.spread(made, "record").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(lp, "DEALT", 50_000)
    dealt = lp.spread(made, "record")
    assert dealt.rdd.getNumPartitions() == 19 and max(dealt.rdd.glom().map(len).collect()) < 100
    assert lp.decode(dealt).count() == 900
    assert lp.spread(made.limit(0), "record").count() == 0
