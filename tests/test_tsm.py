"""Storage files: codings of blocks against plain lists, files against the points they were made of."""

import random

import numpy as np
import pytest

from tsforge.sources import tsm_codec as codec

EDGE = [0, 1, -1, 2, 59, 60, 2**31, 2**59, -(2**59), 2**60, 2**62, 2**63 - 1, -(2**63)]


def series_of(rng, n):
    kind = rng.choice(["run", "seconds", "odd", "far", "any", "edge"])
    if kind == "run":
        return [rng.choice(EDGE[:9]) + i * rng.choice([1, 7]) for i in range(n)] if n < 2 else list(range(5, 5 + n * 10**9, 10**9))
    if kind == "edge":
        return [rng.choice(EDGE) for _ in range(n)]
    step = {"seconds": lambda: rng.randrange(1, 90) * 10**9, "odd": lambda: rng.randrange(1, 10**6), "far": lambda: rng.randrange(2**61), "any": lambda: rng.choice([1, 1, 1, 2, 10**13])}[kind]
    out, now = [], rng.choice([0, -(10**18), 1_700_000_000 * 10**9])
    for _ in range(n):
        out.append(now)
        now += step()
    return [(x + 2**63) % 2**64 - 2**63 for x in out]


@pytest.mark.parametrize("seed", range(40))
def test_times_and_integers(seed):
    rng = random.Random(seed)
    parts = [np.array(series_of(rng, rng.choice([1, 2, 3, 10, 241, 400])), np.int64) for _ in range(12)]
    for encode, decode in ((codec.encode_times, codec.decode_times), (codec.encode_integers, codec.decode_integers)):
        found = decode([encode(p) for p in parts])
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, parts))


@pytest.mark.parametrize("seed", range(40))
def test_floats(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.random(), lambda: round(rng.gauss(20, 5), 1), lambda: rng.choice([0.0, -0.0, 1.5, 1.5, 1.5]), lambda: rng.choice([float("inf"), -float("inf"), 5e-324, 1e308, -1.0])]
    parts = []
    for _ in range(20):
        f = rng.choice(draw)
        parts.append(np.array([f() for _ in range(rng.choice([1, 2, 50, 300]))]))
    found = codec.decode_floats([codec.encode_floats(p) for p in parts])
    assert all(a.tobytes() == b.tobytes() for a, b in zip(found, parts))


def test_a_block_by_hand():
    """Bytes worked out from the format's description, not by the encoder."""
    times = bytes([0x2A]) + (1_000_000_000_000).to_bytes(8, "big") + b"\x05\x03"  # a run: scale 10**10, delta 5, three times
    assert codec.decode_times([times])[0].tolist() == [10**12, 10**12 + 5 * 10**10, 10**12 + 10**11]
    word = (13 << 60 | 7 | 9 << 20 | 1 << 40).to_bytes(8, "big")  # three values of 20 bits
    assert codec.decode_times([bytes([0x10]) + (100).to_bytes(8, "big") + word])[0].tolist() == [100, 107, 116, 117]
    assert codec.decode_integers([bytes([0x10]) + (3).to_bytes(8, "big") + word])[0].tolist() == [-2, -6, -11, -12]
    ones = (1 << 60).to_bytes(8, "big")  # 120 ones
    assert codec.decode_times([bytes([0x11]) + (0).to_bytes(8, "big") + ones])[0].tolist() == list(range(0, 1210, 10))
    assert codec.decode_booleans([b"\x10\x0a\xa0\x40"])[0].tolist() == [True, False, True, False, False, False, False, False, False, True]
    two = np.float64(2.0).view(np.uint64)
    stream = int(two) << 1 | 0  # 2.0, the same again, then the end: 11, lead 1, size 63
    x = int(two) ^ codec.END
    lead, size = 64 - x.bit_length(), x.bit_length()
    stream = (((stream << 2 | 3) << 5 | lead) << 6 | size) << size | x
    n = 64 + 1 + 13 + size
    assert codec.decode_floats([b"\x10" + (stream << (-n % 8)).to_bytes((n + 7) // 8, "big")])[0].tolist() == [2.0, 2.0]


def test_booleans_strings_and_unsigned():
    rng = random.Random(1)
    bools = [np.array([rng.random() < 0.5 for _ in range(n)]) for n in (1, 8, 9, 1000)]
    assert [b.tolist() for b in codec.decode_booleans([codec.encode_booleans(b) for b in bools])] == [b.tolist() for b in bools]
    texts = [["", "é\n\"x\"", "a" * 70_000], ["only"]]
    assert codec.decode_strings([codec.encode_strings(t) for t in texts]) == texts
    big = np.array([0, 2**64 - 1, 2**63, 5], np.uint64)
    assert codec.decode_integers([codec.encode_integers(big)])[0].view(np.uint64).tolist() == big.tolist()


def test_broken_blocks_are_errors():
    good = codec.encode("float64", np.array([1, 2, 3]), np.array([1.0, 2.0, 2.5]))
    assert codec.decode("float64", [good])[0][0].tolist() == [1, 2, 3]
    for bad in (good[:-1], good[:4] + b"\x01" + good[5:], good[:20] + bytes([good[20] ^ 1]) + good[21:], b""):
        with pytest.raises(codec.TsmError):
            codec.decode("float64", [bad])
    with pytest.raises(codec.TsmError):
        codec.decode("int64", [good])
    with pytest.raises(codec.TsmError):
        codec.encode_floats(np.array([1.0, float("nan")]))
    with pytest.raises(codec.TsmError):
        codec.decode_floats([codec.encode_floats(np.array([1.0, 2.5, 7.25]))[:-9]])
    for decode in (codec.decode_times, codec.decode_integers, codec.decode_floats, codec.decode_booleans, codec.decode_strings):
        with pytest.raises(codec.TsmError):
            decode([b"\xf0" + bytes(12)])


# ---------------------------------------------------------------- files

from decimal import Decimal  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tsforge import schema  # noqa: E402
from tsforge.functions.identity import python_identity  # noqa: E402
from tsforge.operators.selection import Selection  # noqa: E402
from tsforge.sources import tsm  # noqa: E402

DRAW = {"float64": lambda r: round(r.random(), 3), "int64": lambda r: r.randrange(-(2**62), 2**62), "uint64": lambda r: Decimal(r.randrange(2**64)), "bool": lambda r: r.random() < 0.5, "string": lambda r: r.choice(["", "é", "x" * 300])}


def points_of(seed, series=6, each=150):
    rng = random.Random(seed)
    rows = []
    for s in range(series):
        tags = {"vsn": f"W{s % 3}", "sensor": f"a ,=b{s}", "node": "n1", "zone": "é"} if s else {}
        for i in range(each):
            time = i * 1_000_000_000 + s
            for kind in schema.VALUE_TYPES:
                cells = [DRAW[kind](rng) if k == kind else None for k in schema.VALUE_TYPES]
                rows.append((f"m {s % 2}=,", tags, time, f"f {kind}", kind, *cells))
    return rows


def plain(rows):
    return sorted(str((r[0], sorted(r[1].items()), *r[2:10])) for r in map(tuple, rows))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tsm"))
    rows = points_of(4)
    made = tsm.write(spark.createDataFrame(rows, schema.POINTS).repartition(3), folder, 3, block=40)
    assert sum(r.points for r in made.collect()) == len(rows) and len(tsm.files_of(folder)) == 3
    return folder, rows


def test_files_give_the_points_they_were_made_of(spark, stored):
    folder, rows = stored
    found = tsm.scan(spark, folder)
    assert found.filter("error is not null").count() == 0
    assert plain(found.select(*found.columns[:10]).collect()) == plain(rows)
    for r in found.select("measurement", "tags", "series_id", "vsn", "sensor", "instrument_id", "identity_source").dropDuplicates(["series_id"]).collect():
        assert (bytes(r.series_id), *r[3:]) == python_identity(r.measurement, dict(r.tags))


def test_blocks_outside_a_range_or_selection_are_not_read(spark, stored, monkeypatch):
    folder, rows = stored
    low, high = 30 * 10**9, 77 * 10**9 + 2
    chosen = Selection.from_document({"selection_version": 1, "selectors": [{"measurement": "m 1=,", "fields": ["f [bi]*"], "tags": {"vsn": ["W0", "W1"]}}]})
    blocks = tsm.index(spark, folder, low, high, chosen.takes)
    every = tsm.index(spark, folder)
    assert 0 < blocks.count() < every.count() / 4
    assert blocks.filter(f"maximum_time < {low} or minimum_time >= {high}").count() == 0
    want = [r for r in rows if low <= r[2] < high and chosen.takes(r[0], r[3], r[1])]
    found = tsm.scan(spark, folder, low, high, chosen.takes)
    assert want and plain(found.select(*found.columns[:10]).collect()) == plain(want)
    by_series = {(r.measurement, tuple(sorted(r.tags.items())), r.field): (r.minimum_time, r.maximum_time) for r in tsm.series_index(every).collect()}
    want = {}
    for m, tags, time, field, *_ in rows:
        a, b = want.get(k := (m, tuple(sorted(tags.items())), field), (time, time))
        want[k] = (min(a, time), max(b, time))
    assert by_series == want


def test_a_range_of_blocks_is_a_task(spark, stored, monkeypatch):
    folder, rows = stored
    monkeypatch.setattr(tsm, "SLOT", 2048)
    monkeypatch.setattr(tsm, "TOGETHER", 4096)
    found = tsm.scan(spark, folder)
    assert found.rdd.getNumPartitions() > 6
    assert plain(found.select(*found.columns[:10]).collect()) == plain(rows)


def test_many_small_blocks_are_many_tasks(spark, tmp_path):
    """A file far below a range of bytes is dealt by its blocks."""
    rows = [("m", {"a": "b"}, i * 10**9, "f", "float64", i / 2, None, None, None, None) for i in range(6000)]
    assert tsm.write(spark.createDataFrame(rows, schema.POINTS), str(tmp_path), 1, block=1).first().blocks == 6000
    found = tsm.scan(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 12
    assert plain(found.select(*found.columns[:10]).collect()) == plain(rows)


def test_broken_files_stop_no_other(spark, stored, tmp_path):
    folder, rows = stored
    good, cut, bad = tsm.files_of(folder)
    with open(good, "rb") as a, open(cut, "rb") as b, open(bad, "rb") as c:
        one, two, three = a.read(), b.read(), bytearray(c.read())
    three[30] ^= 1
    for name, data in (("1.tsm", one), ("2.tsm", two[:-30]), ("3.tsm", bytes(three)), ("4.tsm", b"short"), ("5.tsm", b"\0" * 50)):
        (tmp_path / name).write_bytes(data)
    found = tsm.scan(spark, str(tmp_path), strict=False)
    errors = {r.file[-5:]: r.error for r in found.filter("error is not null").select("file", "error").collect()}
    assert set(errors) == {"2.tsm", "3.tsm", "4.tsm", "5.tsm"} and "checksum" in errors["3.tsm"]
    assert found.filter("error is null and file like '%1.tsm'").count() == tsm.scan(spark, good).count()
    with pytest.raises(Exception, match="checksum"):
        tsm.scan(spark, str(tmp_path / "3.tsm")).count()
    assert tsm.scan(spark, []).count() == 0


def test_the_last_file_wins(spark, tmp_path):
    rows = [("m", {"vsn": "a"}, t, "f", "int64", None, t, None, None, None) for t in range(10)]
    again = [("m", {"vsn": "a"}, t, "f", "int64", None, -t, None, None, None) for t in range(5, 15)]
    tsm.write(spark.createDataFrame(rows, schema.POINTS), str(tmp_path / "a"), 1)
    tsm.write(spark.createDataFrame(again, schema.POINTS), str(tmp_path / "b"), 1)
    (tmp_path / "b" / "000000001-000000001.tsm").rename(tmp_path / "a" / "000000002-000000001.tsm")
    found = tsm.scan(spark, str(tmp_path / "a"))
    assert found.count() == 20
    assert {r.time_ns: r.value_int64 for r in tsm.newest(found).collect()} == {**{t: t for t in range(5)}, **{t: -t for t in range(5, 15)}}


def test_the_data_source_is_given_filters(spark, stored):
    folder, rows = stored
    tsm.register(spark)
    df = spark.read.format("tsm").load(folder)
    assert plain(df.collect()) == plain(rows)
    part = df.filter(f"time_ns >= {20 * 10**9} and time_ns < {30 * 10**9 + 1} and field = 'f bool' and measurement = 'm 1=,'")
    want = [r for r in rows if 20 * 10**9 <= r[2] < 30 * 10**9 + 1 and r[3] == "f bool" and r[0] == "m 1=,"]
    assert want and plain(part.collect()) == plain(want)
    reader = tsm._TsmReader(tsm.files_of(folder))
    assert list(reader.pushFilters([tsm.GreaterThan(("time_ns",), 20), tsm.LessThanOrEqual(("time_ns",), 90), tsm.EqualTo(("field",), "x")])) == [tsm.EqualTo(("field",), "x")]
    assert (reader.low, reader.high) == (21, 91) and reader.partitions()[0].rows == []


def test_two_types_under_one_key_are_an_error(spark, tmp_path):
    rows = [("m", {}, 1, "f", "int64", None, 1, None, None, None), ("m", {}, 2, "f", "bool", None, None, None, True, None)]
    with pytest.raises(Exception, match="two types"):
        tsm.write(spark.createDataFrame(rows, schema.POINTS), str(tmp_path), 1).count()


def test_a_files_index_is_not_held_while_it_is_written(tmp_path):
    """Forty thousand series of one block: what a task holds does not grow with them."""
    import tracemalloc

    writer, peaks = tsm._Writer(str(tmp_path / "x.tsm")), []
    tracemalloc.start()
    for i in range(40_000):
        writer.add(f"m,n={i:06d}{tsm.SEPARATOR}f", "int64", i, i + 1, 2, b"x" * 20)
        if i % 20_000 == 19_999:
            peaks.append(tracemalloc.get_traced_memory()[0])
    tracemalloc.stop()
    assert peaks[1] - peaks[0] < 200_000
    assert writer.finish()["blocks"] == 40_000
    found = list(tsm.read_index(str(tmp_path / "x.tsm")))
    assert len(found) == 40_000 and found[7][1:4] == ("m,n=000007", "f", "int64") and found[7][4]["offset"].tolist() == [5 + 7 * 20]


def test_files_grow_in_number_with_the_points(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tsm, "PER_FILE", 500)
    rows = points_of(5)
    made = tsm.write(spark.createDataFrame(rows, schema.POINTS).repartition(3), str(tmp_path), 2).collect()
    assert len(made) == 9 and max(r.points for r in made) < 1500 and sum(r.points for r in made) == len(rows) == 4500
    found = tsm.scan(spark, str(tmp_path))
    assert plain(found.select(*found.columns[:10]).collect()) == plain(rows)


def test_points_of_several_folders_are_one_job(spark, tmp_path):
    """Tasks meet the ends of folders, whose series have the same keys."""
    rows = points_of(5)
    points = spark.createDataFrame(rows, schema.POINTS).withColumn("to", F.concat(F.lit("b/"), F.pmod(F.hash("time_ns"), F.lit(3)).cast("string")))
    made = tsm.write(points, str(tmp_path), 2, below="to").collect()
    assert sum(r.points for r in made) == len(rows) and 3 <= len(tsm.files_of(str(tmp_path))) == len(made) <= 4  # of two tasks
    for k in range(3):
        own, found = points.filter(f"to = 'b/{k}'").drop("to").collect(), tsm.scan(spark, f"{tmp_path}/b/{k}")
        assert own and plain(found.select(*found.columns[:10]).collect()) == plain(own)
    with pytest.raises(Exception, match="without a folder"):
        tsm.write(points.withColumn("to", F.nullif("to", F.lit("b/1"))), str(tmp_path / "x"), 2, below="to")


def test_blocks_that_are_encoded_together_are_those_encoded_alone():
    rng = random.Random(9)
    sizes = np.array([rng.choice([1, 2, 3, 60, 241, 1000]) for _ in range(40)])
    parts = [np.array(series_of(rng, n), np.int64) for n in sizes]
    floats = [np.array([rng.choice([rng.random(), 1.5, 0.0]) for _ in range(n)]) for n in sizes]
    for kind, values in (("int64", parts), ("uint64", [p.view(np.uint64) for p in parts]), ("float64", floats), ("bool", [p % 2 == 0 for p in parts])):
        together = codec.encode_all(kind, np.concatenate(parts), np.concatenate(values), sizes)
        assert together == [codec.encode(kind, t, v) for t, v in zip(parts, values)]
        for (times, found), t, v in zip(codec.decode(kind, together), parts, values):
            assert times.tolist() == t.tolist() and found.view(v.dtype).tolist() == v.tolist()


@pytest.mark.parametrize("together", [7, 100_000])
def test_blocks_go_on_over_batches(together, monkeypatch):
    import pyarrow as pa

    rows = [(f"k{i // 95}", i, "int64") for i in range(300)]
    table = pa.table({"_key": [r[0] for r in rows], "time_ns": [r[1] for r in rows], "value_type": [r[2] for r in rows], "value_int64": [i * i for i in range(300)]})
    made, rest = [], table.slice(0, 0)
    for at in range(0, 300, together):
        found, rest = tsm._blocks(pa.concat_tables([rest, table.slice(at, together)]), 40, at + together >= 300)
        made += found
    assert [m[:5] for m in made] == [(f"k{k}", "int64", a, min(a + 40, b) - 1, min(a + 40, b) - a) for k, (s, b) in enumerate([(0, 95), (95, 190), (190, 285), (285, 300)]) for a in range(s, b, 40)]
    assert np.concatenate([v for _, v in codec.decode("int64", [m[5] for m in made])]).tolist() == [i * i for i in range(300)]


def test_index_rows_of_many_keys_are_one_batch(spark, stored, monkeypatch):
    folder, rows = stored
    path = tsm.files_of(folder)[0]
    every = [(m, s, f, k, *e) for m, s, f, k, entries in tsm.read_index(path) for e in entries.tolist()]
    for size, batches in ((20_000, 1), (10, None)):
        monkeypatch.setattr(tsm, "ROWS", size)
        found = list(tsm._index_batches(path, tsm.read_index(path)))
        assert [tuple(r.values())[1:9] for b in found for r in b.to_pylist()] == every
        assert len(found) == batches or batches is None and len(found) > 3


def test_series_come_from_footers_that_are_read_once(spark, stored):
    plan = tsm.series_index(tsm.index(spark, stored[0]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # footers, and tags of what is grouped
