import io
import json
import tarfile
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tsforge import cli
from tsforge.operators import catalog, ingest, inventory, ranges, store
from tsforge.functions.identity import DROPPED_TAG
from tsforge.operators.selection import KEYS, NAMES, VERSIONS, Selection
from tsforge.plans import backup, export
from tsforge.sources import line_protocol, tables
from tsforge.streaming import landing

DAY = 1_735_689_600_000_000_000
NEXT = DAY + 86_400_000_000_000
LINES = [
    f"wxt.env.temp,node=n1,sensor=wxt,vsn=W01/West,zone=core value=1.5,other=2i {DAY}",
    f"wxt.env.temp,node=n2,sensor=wxt,vsn=W01/West,zone=core value=2.5 {DAY + 1}",
    f"wxt.env.temp,node=n1,sensor=aqt,vsn=W02 value=3.5 {NEXT - 1}",
    f"wxt.env.temp,node=n1,sensor=wxt value=4.5 {DAY + 5}",
    f"wxt.env.hum,vsn=W01 value=5.5 {DAY + 5}",
    f"wxt.env.temp,sensor=wxt,vsn=W01/West,zone=core value=6.5 {NEXT}",
]
SELECTION = {"selection_version": 2, "selectors": [{"measurement_glob": "wxt.*", "fields": ["value"], "tags": {"sensor": ["wxt"], "vsn": ["W0*"]}}]}


@pytest.fixture
def points(spark):
    records = spark.createDataFrame([(x,) for x in LINES], "record string")
    return ingest.identified(line_protocol.decode(records))


def test_every_row_has_one_fate(points):
    done = ingest.classify(points, DAY, NEXT, Selection.from_document(SELECTION))
    row = ingest.summary(done, by_day=False).first().asDict()
    assert row == {"parsed_rows": 7, "output_rows": 2, "quarantined_rows": 2, "upper_boundary_rows": 1, "filtered_selection_rows": 2, "filtered_instrument_rows": 0}
    assert row["parsed_rows"] == sum(v for k, v in row.items() if k != "parsed_rows")
    days = {str(r.date): r.upper_boundary_rows for r in ingest.summary(done).collect()}
    assert days == {"2025-01-01": 0, "2025-01-02": 1}
    assert {r.reason for r in ingest.quarantine_of(done).collect()} == {"missing-vsn", "missing-sensor"}
    assert all("node" not in r.tags for r in done.select("tags").collect())
    allowed = ingest.classify(points, DAY, NEXT, Selection.from_document(SELECTION), {"nothing"})
    assert ingest.summary(allowed, by_day=False).first().filtered_instrument_rows == 2


def test_a_row_before_the_range_is_an_error(points):
    with pytest.raises(Exception, match="precedes"):
        ingest.classify(points, DAY + 1, NEXT).collect()


def test_catalogs_reconcile(points):
    facts = ingest.facts_of(ingest.classify(points, DAY, NEXT))
    n = facts.count()
    stats = catalog.partition_variables(facts)
    for table in (catalog.sensors(stats), catalog.instruments(stats), catalog.variables(stats), catalog.instrument_variables(stats)):
        assert sum(r["rows"] for r in table.collect()) == n
    assert sum(r.row_count for r in catalog.partition_stats(facts).collect()) == n
    series = catalog.series(facts, "measurement")
    merged = catalog.merge_series(series.unionByName(series), "measurement")
    assert sorted(map(str, series.collect())) == sorted(map(str, merged.select(*series.columns).collect()))
    with pytest.raises(Exception, match="share an id"):
        catalog.series(facts.withColumn("measurement", F.col("time_ns").cast("string")), "measurement").collect()


def broken_selections():
    """A sound selection with one rule broken at a time, by the table of keys."""
    good = {"measurement": "a", "measurement_glob": "a*", "fields": ["x"], "tags": {"vsn": ["W1"]}}
    wrong = {
        "measurement": (None, 7, "", ["a"], "a*"), "measurement_glob": (None, 7, "", ["a*"]),
        "fields": (None, "x", [], [""], ["x", 3]), "tags": (None, ["x"], {"vsn": []}, {"vsn": "W1"}, {DROPPED_TAG: ["x"]}),
    }
    assert set(good) == set(wrong) == set(KEYS)
    whole = lambda selector, version=VERSIONS[-1]: {"selection_version": version, "selectors": [{"measurement": "b"}, selector]}
    for key, values in wrong.items():
        rest = {} if key in NAMES else {"measurement": "a"}
        assert Selection.from_document(whole(rest | {key: good[key]}))
        yield from (whole(rest | {key: v}) for v in values)
        yield from (whole(rest | {key: good[key]}, v) for v in VERSIONS if v < KEYS[key].since)
    yield from (whole({"measurement": "a"}, v) for v in (0, VERSIONS[-1] + 1, "1", None))
    yield from (whole(s) for s in ({}, good, {"measurement": "a", "more": 1}, "a"))
    sound = whole({"measurement": "a"})
    yield from ({k: v for k, v in sound.items() if k != left} for left in sound)
    yield from (sound | {"selectors": s} for s in ([], {}, None))
    yield from (sound | {"more": 1}, [], None)


@pytest.mark.parametrize("document", list(broken_selections()), ids=str)
def test_broken_selections(document):
    with pytest.raises(ValueError):
        Selection.from_document(document)


def test_fingerprints_do_not_depend_on_order():
    a = Selection.from_document({"selection_version": 1, "selectors": [{"measurement": "b", "fields": ["y", "x", "x"]}, {"measurement": "a"}, {"measurement": "a"}]})
    b = Selection.from_document({"selectors": [{"measurement": "a"}, {"fields": ["x", "y"], "measurement": "b"}], "selection_version": 1})
    assert a.fingerprint == b.fingerprint and len(a.selectors) == 2


def test_index_rows(spark):
    text = ["Pos\tMin Time\tMax Time\tOfs\tSize\tKey\tField", "  0\t2025-01-01T00:00:00.5Z\t2025-01-01T01:00:00Z\t5\t9\twxt.env.temp,node=n,sensor=wxt\\ 536\tvalue", "  1\t2025-01-01T01:00:00Z\t2025-01-01T02:00:00Z\t14\t9\twxt.env.temp,node=n,sensor=wxt\\ 536\tvalue", "Statistics"]
    lines = spark.createDataFrame([(t,) for t in text], "value string")
    rows = tables.parse_index(lines).collect()
    assert len(rows) == 2 and rows[0].tags == {"sensor": "wxt 536"} and min(r.minimum_time for r in rows) == DAY + 500_000_000
    rolled = inventory.rollup(tables.parse_index(lines).selectExpr("measurement", "field", "to_json(tags) tags", "minimum_time", "maximum_time", "'s' source", "0 ordinal")).collect()
    assert len(rolled) == 1 and rolled[0].blocks == 2
    with pytest.raises(Exception, match="not an index row"):
        tables.parse_index(spark.createDataFrame([("7\tbroken",)], "value string")).collect()


def test_backup_manifest(spark, tmp_path):
    (tmp_path / "s1.tar.gz").write_text("x")
    document = {"buckets": [{"bucketID": "b1", "bucketName": "n", "retentionPolicies": [{"shardGroups": [{"startTime": "2025-01-01T00:00:00Z", "endTime": "2025-01-08T00:00:00Z", "shards": [{"id": 4, "fileName": "s1.tar.gz", "size": 9}]}]}]}]}
    (tmp_path / "x.manifest").write_text(json.dumps(document))
    (tmp_path / "._x.manifest").write_text("junk")
    assert tables.load_backup(str(tmp_path), "b1")["shards"][0]["id"] == 4
    assert tables.backup_shards(spark, str(tmp_path / "x.manifest")).first().file == "s1.tar.gz"
    with pytest.raises(ValueError):
        tables.load_backup(str(tmp_path), "b2")
    with pytest.raises(ValueError):
        tables.staged_members([("../x.tsm", 1)], "", 100)
    assert tables.staged_members([("b1/a.tsm", 1), ("b2/b.tsm", 1), ("b1/c.txt", 1)], "b1/", 100) == ["b1/a.tsm"]
    command = tables.export_command("x", "/e", "b1", ["m2", "m1", "m1"], datetime(2025, 1, 1, tzinfo=UTC), datetime(2025, 1, 2, tzinfo=UTC))
    assert command.count("--measurement") == 2 and "2025-01-01T00:00:00Z" in command


def test_archives_are_staged_safely(tmp_path):
    def make(name, members):
        with tarfile.open(tmp_path / name, "w:gz") as t:
            for path, data in members:
                info = tarfile.TarInfo(path)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
        return str(tmp_path / name)

    good = make("a.tgz", [("b1/x/1.tsm", b"abc"), ("b1/x/fields.idx", b"z"), ("b2/2.tsm", b"d")])
    assert [p.removeprefix(str(tmp_path)) for p in tables.stage_archive(good, str(tmp_path / "out"), "b1/")] == ["/out/b1/x/1.tsm"]
    for name, members in (("b.tgz", [("../1.tsm", b"a")]), ("c.tgz", [("/1.tsm", b"a")]), ("d.tgz", [("1.tsm", b"a"), ("1.tsm", b"b")]), ("e.tgz", [("1.txt", b"a")])):
        with pytest.raises(ValueError):
            tables.stage_archive(make(name, members), str(tmp_path / name[0]))


def test_stores(spark, points, tmp_path):
    facts = ingest.facts_of(ingest.classify(points, DAY, NEXT))
    store.write_facts(facts, str(tmp_path))
    back = tables.read_facts(spark, f"{tmp_path}/facts/**/*.parquet")
    assert back.count() == facts.count() and {r.vsn for r in back.select("vsn").collect()} == {"W01/West", "W02"}
    assert all(r._source_file.endswith(".parquet") for r in back.collect()) and tables.source_files(back).count() >= 2
    plan = back.filter("sensor = 'wxt' and date = '2025-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sensor" in plan
    done = back.select("sensor", "vsn", "instrument", "date").distinct().filter("sensor = 'wxt'").withColumn("rules", F.lit("v1"))
    left = store.unfinished(back, done, {"rules": "v1"}, "skip")
    assert {r.sensor for r in left.collect()} == {"aqt"}
    with pytest.raises(FileExistsError):
        store.unfinished(back, done, {"rules": "v1"})
    with pytest.raises(ValueError):
        store.unfinished(back, done, {"rules": "v2"}, "skip")
    store.guard_identity(spark, f"{tmp_path}/d", {"a": 1})
    store.guard_identity(spark, f"{tmp_path}/d", {"a": 1})
    with pytest.raises(ValueError):
        store.guard_identity(spark, f"{tmp_path}/d", {"a": 2})


def test_streaming_takes_each_file_once(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.lp").write_text("\n".join(LINES) + "\n")
        landing.ingest_available(spark, str(folder), str(root), str(tmp_path / "ck"), DAY, NEXT, Selection.from_document(SELECTION))
        facts = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/facts")
        assert facts.count() == 2 * (i + 1)


def test_exports_resume_and_reconcile(spark, tmp_path):
    records = spark.createDataFrame([(x,) for x in LINES], "record string")
    points, root = line_protocol.decode(records), str(tmp_path / "out")
    start, end = export.day_range("2025-01-01")
    first = export.export_days(points, root, "r1", start, end)
    assert first["status"] == "complete" and first["output_rows"] == first["published_rows"] == 4 and first["quarantined_rows"] == 2
    with pytest.raises(FileExistsError):
        export.export_days(points, root, "r2", start, end)
    again = export.export_days(points, root, "r3", start, end, on_existing="skip")
    assert again["published_rows"] == 0 and again["skipped_existing_rows"] == 4
    both = export.export_days(points, root, "r4", *export.day_range("2025-01-01", "2025-01-02"), on_existing="skip")
    assert both["published_rows"] == 1 and both["requested_days"] == 2
    n = spark.read.parquet(f"{root}/facts").count()
    assert n == 5 == sum(int(r["rows"]) for r in spark.read.option("header", "true").csv(f"{root}/catalogs/variables").collect())
    with pytest.raises(ValueError):
        export.export_days(points, root, "r5", start, end, Selection.from_document(SELECTION))


@pytest.mark.parametrize("broken", ["write_series", "write_quarantine", "write_facts", "rename"])
def test_an_export_that_was_cut_short_is_made_good(spark, tmp_path, monkeypatch, broken):
    """Whatever fails, the next run gives the rows of one that never failed."""
    points, root = line_protocol.decode(spark.createDataFrame([(x,) for x in LINES], "record string")), str(tmp_path / "out")
    start, end = export.day_range("2025-01-01")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store.Files if broken == "rename" else store, broken, fail)
        with pytest.raises(OSError):
            export.export_days(points, root, "r1", start, end)
    assert export.partitions(spark, root) is None
    only = export.export_days(points.filter("time_ns < 1735689600000000002"), root, "r2", start, end, on_existing="skip")
    assert spark.read.parquet(f"{root}/facts").count() == only["published_rows"] == 3  # what no audit knows is gone
    again = export.export_days(points, root, "r1", start, end, on_existing="skip")
    assert again["status"] == "complete" and again["published_rows"] == 1 and spark.read.parquet(f"{root}/facts").count() == 4
    assert not store.Files(spark).names(f"{root}/_staging") and len(store.Files(spark).names(f"{root}/_partitions")) == 2
    found = {(r.vsn, r.row_count): r for r in export.manifests(spark, root).collect()}
    assert found["W01/West", 3].measurements == {"wxt.env.temp": 3} and found["W01/West", 3].value_types == {"float64": 2, "int64": 1} and found["W02", 1].fields == {"value": 1}
    assert {r.status for r in found.values()} == {"complete"} and {r.engine for r in found.values()} == {export.__version__}


def test_exports_ask_for_review(spark, tmp_path):
    made = lambda lines, name: export.export_days(line_protocol.decode(spark.createDataFrame([(x,) for x in lines], "record string")), str(tmp_path / name), "r1", *export.day_range("2025-01-01"))
    plain = [f"m.t,sensor=s,vsn=W1,description=ambient v=1 {DAY}"]
    assert made(plain, "a")["requires_review"] is False
    both = made([*plain, f"m.t,sensor=s,vsn=W2,description=enclosure v=1 {DAY}"], "b")
    assert both["metadata_conflicts"] == 1 and both["requires_review"] is True
    assert made([*plain, f"m.t,sensor=s v=1 {DAY}"], "c")["requires_review"] is True


def inspected(log, index, given):
    """What a storage binary would say of shards; it notes what it is asked."""

    class Inspected:  # in here, so that workers get it by value
        def index(self, path):
            return index

        def lines(self, engine, bucket, measurements, start, end):
            with open(log, "a") as f:
                f.write(json.dumps([measurements, str(start), str(end)]) + "\n")
            return [x.encode() + b"\n" for x in given if x.split(",")[0] in measurements]

    return Inspected()


def test_backup_ranges_are_exported_once(spark, tmp_path):
    document = {"buckets": [{"bucketID": "b1", "bucketName": "n", "retentionPolicies": [{"shardGroups": [{"startTime": "2024-12-30T00:00:00Z", "endTime": "2025-01-03T00:00:00Z", "shards": [{"id": 4, "fileName": "s4.tar.gz", "size": 9}]}, {"startTime": "2025-01-05T00:00:00Z", "endTime": "2025-01-06T00:00:00Z", "shards": [{"id": 5, "fileName": "s5.tar.gz", "size": 9}]}]}]}]}
    (tmp_path / "snap.manifest").write_text(json.dumps(document))
    for name in ("s4", "s5"):
        with tarfile.open(tmp_path / f"{name}.tar.gz", "w:gz") as t:
            info = tarfile.TarInfo("b1/autogen/1/one.tsm")
            info.size = 3
            t.addfile(info, io.BytesIO(b"abc"))
    entry = lambda i, key: f"  {i}\t2025-01-01T00:00:00Z\t2025-01-02T00:00:00Z\t5\t9\t{key}\tvalue\n"
    index = ["Index:\n", entry(1, "wxt.env.temp,node=n1,sensor=wxt,vsn=W01"), entry(2, "wxt.env.hum,node=n1,sensor=wxt,vsn=W01"), entry(3, "wxt.env.press,sensor=aqt,vsn=W02")]
    lines = [f"wxt.env.temp,node=n1,sensor=wxt,vsn=W01 value=1 {DAY + 1}", f"wxt.env.hum,node=n1,sensor=wxt,vsn=W01 value=2 {NEXT + 1}", f"wxt.env.temp,sensor=aqt,vsn=W02 value=9 {NEXT + 2}", f"wxt.env.temp,sensor=wxt,vsn=W01 value=3 {NEXT + 86_400 * 10**9}"]
    log, out = tmp_path / "log", str(tmp_path / "out")
    selection = Selection.from_document({"selection_version": 2, "selectors": [{"measurement_glob": "wxt.*", "tags": {"sensor": ["wx?"]}}]})
    found = tables.load_backup(str(tmp_path), "b1")
    asked = lambda: [json.loads(x) for x in log.read_text().splitlines()]
    first = backup.export_backup(spark, found, out, date(2025, 1, 1), date(2025, 1, 3), inspected(str(log), index, lines), selection, work=str(tmp_path))
    assert first["status"] == "complete" and first["output_rows"] == first["published_rows"] == 2 and first["parsed_rows"] == 4 and not first["requires_review"]
    assert {tuple(map(str, x)) for x in asked()} == {("['wxt.env.hum', 'wxt.env.temp']", "2025-01-01 00:00:00+00:00", "2025-01-03 00:00:00+00:00")}
    assert {(r.measurement, str(r.date)) for r in spark.read.parquet(f"{out}/facts").collect()} == {("wxt.env.temp", "2025-01-01"), ("wxt.env.hum", "2025-01-02")}
    before = asked()
    (tmp_path / "s4.tar.gz").unlink()
    second = backup.export_backup(spark, found, out, date(2025, 1, 1), date(2025, 1, 3), inspected(str(log), index, lines), selection)
    assert second["status"] == "complete" and [s["resumed"] for s in second["shards"]] == [True] and asked() == before
    # other days: the archive is gone, and one day has no shard; the other shard is exported all the same
    third = backup.export_backup(spark, found, out, date(2025, 1, 2), date(2025, 1, 6), inspected(str(log), index, []), selection)
    assert third["status"] == "incomplete" and {e["source"] for e in third["errors"]} == {"s4.tar.gz", "2025-01-03", "2025-01-04"} and len(third["shards"]) == 1
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("shard-")]


def test_discovery_agrees_with_columns(spark):
    selection = Selection.from_document(SELECTION)
    rows = [("wxt.a", "value", {"sensor": "wxt", "vsn": "W01"}), ("wxt.b", "other", {"sensor": "wxt", "vsn": "W01"}), ("wxt.c", "value", {"vsn": "W01"}), ("aqt.a", "value", {"sensor": "wxt", "vsn": "W02"}), ("wxt.d", "value", {"sensor": "wxt", "vsn": "W1"})]
    df = spark.createDataFrame(rows, "measurement string, field string, tags map<string,string>")
    taken = {r.measurement for r in df.filter(selection.matches(F.col("measurement"), F.col("field"), F.col("tags"))).collect()}
    assert taken == {m for m, f, t in rows if selection.takes(m, f, t)} == {"wxt.a"}
    with pytest.raises(ValueError, match="not an index row"):
        backup.discover(["7\tbroken"], selection)


def test_inventories_are_brought_up_to_date(spark, tmp_path):
    row = "0\t2025-01-01T00:00:00Z\t2025-01-01T01:00:00Z\t5\t9\tm,node=n,vsn=W1\tvalue\n"
    folder, root = tmp_path / "in", str(tmp_path / "kept")
    folder.mkdir()
    (folder / "a.txt").write_text(row * 2)
    (folder / "b.txt").write_text(row)
    state = lambda found: {r.source.rsplit("/", 1)[1]: (r.status, r.rows) for r in found.collect()}
    assert state(inventory.update(spark, str(folder), root)) == {"a.txt": ("complete", 2), "b.txt": ("complete", 1)}
    files = sorted(p.name for p in (tmp_path / "kept").rglob("*.parquet"))
    inventory.update(spark, str(folder), root)
    assert files == sorted(p.name for p in (tmp_path / "kept").rglob("*.parquet"))  # nothing is read again
    (folder / "b.txt").write_text(row * 3 + "1\tbroken\n")
    (folder / "c.txt").write_text(row)
    assert state(inventory.update(spark, str(folder), root)) == {"a.txt": ("complete", 2), "b.txt": ("error", 4), "c.txt": ("complete", 1)}
    assert inventory.entries(spark, root).count() == 3  # b took back what it gave


def test_a_broken_dump_stops_no_other(spark, tmp_path):
    row = "0\t2025-01-01T00:00:00Z\t2025-01-01T01:00:00Z\t5\t9\tm,node=n,vsn=W1\tvalue\n"
    (tmp_path / "a.txt").write_text("Header\n" + row + row)
    (tmp_path / "b.txt").write_text(row + "1\tbroken\n")
    entries, sources = inventory.load(spark, str(tmp_path))
    assert entries.count() == 2 and {r.status for r in sources.collect()} == {"complete", "error"}
    out = tmp_path.with_name(tmp_path.name + "-out")
    assert cli.main(["inventory", "--input", str(tmp_path), "--output", str(out), "--family", "M"]) == 0
    assert [r.value for r in spark.read.text(f"{out}/family_measurements").collect()] == ["m"]
    read = lambda name: spark.read.option("header", "true").csv(f"{out}/{name}").collect()
    assert [(r.vsn, r.variables) for r in read("instruments")] == [("W1", "1")] and read("measurements")[0].series == "1"
    assert read("instrument_variables")[0].blocks == "2" and {r.status for r in read("status")} == {"complete", "error"}


def test_ranges(spark):
    rows = [(1, date(2025, 1, 1), date(2025, 1, 4)), (2, date(2025, 1, 5), date(2025, 1, 5)), (3, date(2024, 1, 1), date(2024, 2, 1))]
    df = spark.createDataFrame(rows, "id int, a date, b date")
    clipped = ranges.overlapping(df, "a", "b", date(2025, 1, 2), date(2025, 2, 1))
    assert [tuple(r) for r in clipped.collect()] == [(1, date(2025, 1, 2), date(2025, 1, 4))]
    days = ranges.expanded(df, "a", "b")
    assert days.filter("id = 1").count() == 3 and days.filter("id = 2").count() == 0
    assert ranges.missing_days(days.filter("id = 1").select("day"), days.filter("day < '2025-01-02'")).count() == 2


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    (tmp_path / "in.lp").write_text("\n".join(LINES) + "\n")
    (tmp_path / "sel.json").write_text(json.dumps(SELECTION))
    arguments = ["convert", "--input", str(tmp_path / "in.lp"), "--output", str(tmp_path / "out"), "--run-id", "r1", "--date", "2025-01-01", "--selection", str(tmp_path / "sel.json")]
    assert cli.main(arguments) == 0
    assert '"output_rows": 2' in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/out/facts").count() == 2 and spark.read.parquet(f"{tmp_path}/out/_series").count() == 1
    assert spark.read.option("header", "true").csv(f"{tmp_path}/out/catalogs/variables").count() == 1
    (tmp_path / "sel.json").write_text(json.dumps({"selection_version": 1, "selectors": [{"measurement": "wxt.env.temp"}]}))
    assert cli.main(arguments) == 2
    piped = io.TextIOWrapper(io.BytesIO((tmp_path / "in.lp").read_bytes()))
    monkeypatch.setattr("sys.stdin", piped)
    assert cli.main(["convert", "--input", "-", "--output", str(tmp_path / "out2"), "--run-id", "r1", "--date", "2025-01-01"]) == 0
    assert spark.read.parquet(f"{tmp_path}/out2/facts").count() == 4 and not (tmp_path / "out2/_spool").exists()


def test_downsampling(spark):
    rows = [(1, "t", i * 10**9, float(i)) for i in range(90)] + [(1, "t", 10**11, None)]
    df = spark.createDataFrame(rows, "series_id long, variable string, time_ns long, observed_value double")
    out = {r.window_start_s: (r.samples, r.mean) for r in landing.downsample(df, 60, 60, 0.75).collect()}
    assert out == {0: (60, 29.5), 60: (30, None)}


def test_manifests_on_lines(spark, tmp_path):
    """Many manifests in a file give their shards; numbers may be text, and one that is broken is an error."""
    manifest = lambda i, n: {"other": 1, "buckets": [{"bucketID": f"b{i}", "retentionPolicies": [{"shardGroups": [{"startTime": "s", "endTime": "e", "shards": [{"id": n, "fileName": f"{n}.tar.gz", "size": 9}]}]}]}]}
    (tmp_path / "a.json").write_text("\n".join(json.dumps(manifest(i, i if i % 2 else str(i))) for i in range(50)) + "\n")
    found = tables.backup_shards(spark, str(tmp_path), lines=True)
    assert sorted((r.bucket_id, r.shard_id, r.size, r.end) for r in found.collect()) == sorted((f"b{i}", i, 9, "e") for i in range(50))
    (tmp_path / "b.json").write_text('{"buckets": [{"bucketID": "b1"')
    for lines in (True, False):
        with pytest.raises(Exception, match=r"(?i)malformed"):
            tables.backup_shards(spark, str(tmp_path / "b.json"), lines).collect()


def test_the_manifests_of_a_table_are_few_files(spark, tmp_path, monkeypatch):
    """Files grow with the bytes and not with the manifests."""
    from tsforge import queries

    spark.range(40_000).selectExpr("id o_orderkey", "'F' o_orderstatus", "id % 7 o_custkey", "timestamp_ntz'2024-01-01 00:00:00' o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries.store, "scratch", lambda spark, name: str(tmp_path / name))
    assert queries.backup_manifest(spark, str(tmp_path)).count() == 40_000
    assert len(list((tmp_path / "manifests").rglob("*.json"))) <= 8


def test_an_index_line_is_taken_apart_once(spark):
    """Odd lines, and a plan in which no regular expression is repeated for what is made of a line."""
    row = lambda low="2025-01-01T00:00:00Z", key="m,a=b", field="f": f" 1\t{low}\t2025-01-02T03:04:05.000000006Z\t5\t9\t{key}\t{field}"
    text = [row(), row("1960-01-01T00:00:00.5Z"), row(field="a\tb"), row(field="f\r"), row("2025-13-01T00:00:00Z"), row("2025-01-01T00:00:00"), row("9999-01-01T00:00:00Z"), row(key=""), row(key="m,broken"), "2\tno", "x", None]
    lines = spark.createDataFrame([(t, i) for i, t in enumerate(text)], "value string, n int")
    found = {r.n: r for r in tables.index_rows(lines, "value", "n").collect()}
    assert {n for n, r in found.items() if r.fits} == {0, 1, 2, 3} and {n for n, r in found.items() if not r.fits} == set(range(4, 10))
    assert found[1].minimum_time == -315_619_200 * 10**9 + 500_000_000 and found[0].maximum_time == DAY + (86_400 + 3 * 3600 + 4 * 60 + 5) * 10**9 + 6
    assert (found[2].field, found[3].field, found[0].measurement, found[0].tags, found[9]._line) == ("a\tb", "f", "m", {"a": "b"}, "2\tno")
    plan = tables.parse_index(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "Join" not in plan and len(plan) < 5000
