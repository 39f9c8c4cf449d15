"""Backups whose shards are read natively, all in one job."""

import json
from datetime import UTC, date, datetime
from pathlib import Path

import pytest

from tsforge import cli, schema
from tsforge.operators.selection import Selection
from tsforge.plans import backup
from tsforge.sources import tables, tsm

START = 1_735_689_600  # 2025-01-01


def row(measurement, tags, day, second, value):
    return (measurement, tags, (START + day * 86_400 + second) * 10**9, "value", "float64", value, None, None, None, None)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Three shards of two days; each has two files, and the last archive is cut short."""
    folder = tmp_path_factory.mktemp("backup")
    groups = []
    for shard in (1, 2, 3):
        days = (2 * shard - 2, 2 * shard - 1)
        rows = [row(f"wxt.env.{name}", {"sensor": "wxt", "vsn": vsn, "node": "n"}, day, second, float(second)) for name in ("temp", "hum") for vsn in ("W1", "W2") for day in days for second in range(0, 80_000, 8_000)]
        rows += [row("wxt.env.temp", {"sensor": "other", "vsn": "W1"}, days[0], s, 1.0) for s in range(5)]
        rows += [row("wxt.env.temp", {"vsn": "W1"}, days[0], 7, 1.0), row("aqt.x", {"sensor": "aqt", "vsn": "W1"}, days[1], 7, 1.0)]
        tsm.write(spark.createDataFrame(rows, schema.POINTS), f"{folder}/engine/b1/autogen/{shard}", 2)
        moment = lambda d: datetime.fromtimestamp(START + d * 86_400, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        groups.append({"startTime": moment(days[0]), "endTime": moment(days[1] + 1), "shards": [{"id": shard, "fileName": f"s{shard}.tar.gz", "size": 100}]})
    (folder / "snap.manifest").write_text(json.dumps({"buckets": [{"bucketID": "b1", "bucketName": "n", "retentionPolicies": [{"shardGroups": groups}]}]}))
    backup.archive(spark, [(f"{folder}/s{i}.tar.gz", f"{folder}/engine", f"b1/autogen/{i}") for i in (1, 2, 3)])
    broken = Path(f"{folder}/s3.tar.gz")
    broken.write_bytes(broken.read_bytes()[:-200])
    return str(folder)


WANTED = Selection.from_document({"selection_version": 2, "selectors": [{"measurement_glob": "wxt.*", "tags": {"sensor": ["wx?"]}}]})


def test_all_shards_are_one_job(spark, made, tmp_path, monkeypatch):
    root, found = str(tmp_path / "out"), tables.load_backup(made, "b1")
    calls = []
    export_days = backup.export.export_days
    monkeypatch.setattr(backup.export, "export_days", lambda *a, **k: calls.append(a) or export_days(*a, **k))
    first = backup.export_backup(spark, found, root, date(2025, 1, 2), date(2025, 1, 6), selection=WANTED)
    assert len(calls) == 1
    # day 2 of shard 1 (40 points), both days of shard 2 (80, and those of another sensor, and one without)
    by_shard = {s["shard"]: (s["parsed_rows"], s["output_rows"], s["quarantined_rows"], s["filtered_selection_rows"]) for s in first["shards"]}
    assert by_shard == {1: (40, 40, 0, 0), 2: (86, 80, 1, 5)}
    assert first["status"] == "incomplete" and [e["source"] for e in first["errors"]] == ["s3.tar.gz"] and first["published_rows"] == 120 and first["requires_review"]
    facts = spark.read.parquet(f"{root}/facts")
    assert facts.count() == 120 and {str(r.date) for r in facts.select("date").distinct().collect()} == {"2025-01-02", "2025-01-03", "2025-01-04"}
    assert facts.filter("value_float64 <> pmod(time_ns div 1000000000, 86400)").count() == 0

    again = backup.export_backup(spark, found, root, date(2025, 1, 2), date(2025, 1, 5), selection=WANTED)
    assert again["status"] == "complete" and all(s["resumed"] for s in again["shards"]) and len(calls) == 1
    broken = backup.export_backup(spark, found, root, date(2025, 1, 2), date(2025, 1, 6), selection=WANTED)
    assert [e["source"] for e in broken["errors"]] == ["s3.tar.gz"] and len(calls) == 2 and spark.read.parquet(f"{root}/facts").count() == 120


def test_a_broken_block_takes_its_shard_out(spark, made, tmp_path):
    engine = tmp_path / "engine/b1/autogen"
    for shard in (1, 2):
        (engine / str(shard)).mkdir(parents=True)
        for path in tsm.files_of(f"{made}/engine/b1/autogen/{shard}"):
            data = bytearray(Path(path).read_bytes())
            if shard == 2 and path.endswith("1.tsm"):
                data[12] ^= 1
            (engine / str(shard) / Path(path).name).write_bytes(bytes(data))
    backup.archive(spark, [(f"{tmp_path}/s{i}.tar.gz", f"{tmp_path}/engine", f"b1/autogen/{i}") for i in (1, 2)])
    found = tables.load_backup(made, "b1")
    found["shards"] = [s | {"path": f"{tmp_path}/s{s['id']}.tar.gz"} for s in found["shards"][:2]]
    manifest = backup.export_backup(spark, found, str(tmp_path / "out"), date(2025, 1, 1), date(2025, 1, 5), work=str(tmp_path))
    assert [(e["source"], "checksum" in e["error"]) for e in manifest["errors"]] == [("s2.tar.gz", True)] and [s["shard"] for s in manifest["shards"]] == [1]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("shards-")]


def test_listed_instruments_from_the_command_line(spark, made, tmp_path):
    first = backup.export_backup(spark, tables.load_backup(made, "b1"), str(tmp_path / "a"), date(2025, 1, 1), date(2025, 1, 2), selection=WANTED)
    ids = [r.instrument_id for r in spark.read.parquet(f"{tmp_path}/a/facts").select("instrument_id", "vsn").distinct().filter("vsn = 'W2'").collect()]
    (tmp_path / "ids").write_text("# these\n" + "\n".join(ids))
    (tmp_path / "wanted.json").write_text(json.dumps({"selection_version": 2, "selectors": [{"measurement_glob": "wxt.*", "tags": {"sensor": ["wx?"]}}]}))
    args = ["backup", "--input", made, "--bucket", "b1", "--output", str(tmp_path / "b"), "--date", "2025-01-01", "--selection", str(tmp_path / "wanted.json"), "--allow", str(tmp_path / "ids")]
    assert cli.main(args) == 0
    facts = spark.read.parquet(f"{tmp_path}/b/facts")
    assert facts.count() == first["output_rows"] / 2 and {r.vsn for r in facts.select("vsn").distinct().collect()} == {"W2"}


def test_days_of_an_engine_folder(spark, made, tmp_path, capsys):
    engine = tmp_path / "engine"
    (engine / "data").mkdir(parents=True)
    (engine / "data" / "b1").symlink_to(f"{made}/engine/b1")
    (tmp_path / "wanted.json").write_text(json.dumps({"selection_version": 2, "selectors": [{"measurement_glob": "wxt.*", "tags": {"sensor": ["wx?"]}}]}))
    args = ["engine", "--input", str(engine), "--bucket", "b1", "--output", str(tmp_path / "out"), "--run-id", "r1", "--date", "2025-01-02", "--last-date", "2025-01-05", "--selection", str(tmp_path / "wanted.json")]
    for run, expected in (("r1", 160), ("r2", 0)):  # and nothing twice
        args[8] = run
        assert cli.main(args) == 0
        said = json.loads(capsys.readouterr().out)
        assert (said["output_rows"], said["quarantined_rows"], said["filtered_selection_rows"], said["published_rows"]) == (160, 2, 10, expected)
    assert spark.read.parquet(f"{tmp_path}/out/facts").count() == 160


def test_a_shard_that_grows_is_written_as_more_files(spark, tmp_path, monkeypatch):
    """The query's backup: as many files (and tasks) to a shard as its points want."""
    from tsforge import queries

    rows = spark.range(6000).selectExpr("id event_id", "timestampadd(SECOND, id * 280, timestamp_ntz'2024-01-01 00:00:00') ts", "id % 50 user_id", "'click' event_type", "id / 7.0D value", "'p' props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(tsm, "PER_FILE", 300)
    found = queries._backup(spark, str(tmp_path), str(tmp_path / "b"))["shards"]
    files = [tsm.files_of(f"{tmp_path}/b/engine/b1/autogen/{s['id']}") for s in found]
    assert all(len(f) >= 5 for f in files)
    read = tsm.scan(spark, [x for f in files for x in f])
    assert read.count() == queries._nodes(spark, str(tmp_path)).filter("value is not null and not isnan(value) and time_ns < 1705881600000000000").count()


def test_the_shards_of_a_backup_are_written_in_one_pass(spark, tmp_path, monkeypatch):
    from tsforge import queries

    rows = spark.range(3000).selectExpr("id event_id", "timestampadd(SECOND, id * 580, timestamp_ntz'2024-01-01 00:00:00') ts", "id % 50 user_id", "'click' event_type", "id / 7.0D value", "'p' props")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    calls, write = [], tsm.write
    monkeypatch.setattr(tsm, "write", lambda *a, **k: calls.append(a) or write(*a, **k))
    found = queries._backup(spark, str(tmp_path), str(tmp_path / "b"))["shards"]
    assert len(calls) == 1
    for s in found:
        low, high = (int(s[k].timestamp()) * 10**9 for k in ("start", "end"))
        want = queries._nodes(spark, str(tmp_path)).filter(f"value is not null and not isnan(value) and time_ns >= {low} and time_ns < {high}")
        read = tsm.scan(spark, f"{tmp_path}/b/engine/b1/autogen/{s['id']}")
        assert read.count() == want.count() > 0 and read.agg({"time_ns": "min"}).first()[0] >= low and read.agg({"time_ns": "max"}).first()[0] < high


def test_each_archive_and_each_footer_is_a_task(spark, tmp_path):
    from pyspark.sql import functions as F

    tasks = lambda rows: rows.groupBy(F.spark_partition_id()).count().collect()
    for n in (3, 8, 20):
        assert [r[1] for r in tasks(backup._shard_rows(spark, [{"id": i, "path": f"/s{i}"} for i in range(n)]))] == [1] * n
    rows = [row("m.x", {"sensor": "s", "vsn": f"W{i % 12}"}, 1, i, 1.0) for i in range(240)]
    tsm.write(spark.createDataFrame(rows, schema.POINTS), str(tmp_path), 6)
    found = tsm.files_of(str(tmp_path))
    for listed in (str(tmp_path), spark.createDataFrame([(f,) for f in found], "file string")):
        assert len(tasks(tsm.index(spark, listed))) == len(found) > 3
