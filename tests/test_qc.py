import copy
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tsforge import cli
from tsforge.functions import times
from tsforge.functions.times import Period
from tsforge.plans import level1, qc, runner
from tsforge.plans.qc_config import ConfigError, Rules, Run, config_hash
from tsforge.sources import cdf

DAY = 1_735_689_600_000_000_000
T0, T3 = datetime(2025, 1, 1, tzinfo=UTC), datetime(2025, 1, 4, tzinfo=UTC)


def variable(measurement, left, right, narrow=None):
    checks = [{"id": f"{measurement}_missing", "method": "col_vals_not_null", "flag": "missing_value"}, {"id": f"{measurement}_physical", "method": "col_vals_between", "flag": "physical_range", "args": {"left": left, "right": right}}]
    if narrow:
        checks.append({"id": f"{measurement}_instrument", "method": "col_vals_between", "flag": "instrument_range", "args": {"left": narrow[0], "right": narrow[1]}})
    return {"column": "value_float64", "where": {"measurement": measurement, "field": "value", "value_type": "float64"}, "missing_values": [-9999.9], "checks": checks}


RULES = {
    "schema_version": 1,
    "flags": {"missing_value": {"bit": 0}, "missing_sample": {"bit": 1}, "physical_range": {"bit": 2}, "instrument_range": {"bit": 3}},
    "profiles": {"wxt": {"variables": {"temperature": variable("temp", -80, 70, (-50, 60)), "wind": variable("wind", 0, 100), "clock": {"column": "value_string", "where": {"measurement": "clock", "field": "value"}, "missing_strings": ["", "none"], "checks": [{"id": "clock_missing", "method": "col_vals_not_null", "flag": "missing_value"}]}}}},
}
KEYS = ("time_ns", "series_id")
FACTS = "time_ns long, sensor string, series_id string, measurement string, field string, value_type string, value_float64 double, value_string string"


def fact(t, measurement, value, text=None):
    return (DAY + t, "wxt", f"s-{measurement}", measurement, "value", "string" if text is not None else "float64", value, text)


ROWS = [fact(0, "temp", 10.0), fact(1, "temp", float("nan")), fact(2, "temp", 65.0), fact(3, "temp", 100.0), fact(4, "wind", 5.0), fact(5, "other", 999.0), fact(6, "temp", -9999.9), fact(7, "clock", None, "none"), fact(8, "clock", None, "12:00")]


@pytest.fixture
def rules():
    return Rules.from_document(RULES)


def seen(spark, rules, rows=ROWS):
    profile = rules.profiles["wxt"]
    return qc.normalize(qc.select(spark.createDataFrame(rows, FACTS), profile), profile, KEYS)


def test_findings_results_and_masks(spark, rules):
    profile, rows = rules.profiles["wxt"], seen(spark, rules)
    found = qc.findings(rows, profile, rules)
    got = sorted((r.time_ns - DAY, r.check_id, r.bit) for r in found.collect())
    assert got == [(1, "temp_missing", 0), (2, "temp_instrument", 3), (3, "temp_instrument", 3), (3, "temp_physical", 2), (6, "temp_missing", 0), (7, "clock_missing", 0)]
    results = {r.check_id: r for r in qc.check_results(rows, profile, rules).collect()}
    assert results["temp_missing"].units_tested == 5 and results["temp_missing"].fraction_failed == 0.4
    for r in results.values():
        assert r.units_tested == r.units_passed + r.units_failed == r.units_tested
        assert r.units_failed == sum(c == r.check_id for _, c, _ in got)
    flagged = qc.attach_masks(rows, qc.compile_masks(found, KEYS), KEYS)
    assert {r.time_ns - DAY: int(r.qc_bits) for r in flagged.collect()} == {0: 0, 1: 1, 2: 8, 3: 12, 4: 0, 6: 1, 7: 1, 8: 0}


def test_empty_input_still_reports_each_check(spark, rules):
    rows = seen(spark, rules, [])
    results = qc.check_results(rows, rules.profiles["wxt"], rules).collect()
    assert len(results) == 6 and all(r.units_tested == 0 and r.fraction_failed == 0 for r in results)
    found = qc.findings(rows, rules.profiles["wxt"], rules)
    assert found.count() == 0 and qc.compile_masks(found, KEYS).count() == 0


def test_bit_63_and_repeated_findings(spark):
    rows = [(1, "s", "v", 0), (1, "s", "v", 63), (1, "s", "v", 63), (None, "s", "v", 2)]
    found = spark.createDataFrame(rows, "time_ns long, series_id string, variable string, bit int").withColumns({"run_id": F.lit("r"), "work_unit_id": F.lit("u")})
    masks = qc.compile_masks(found, KEYS)
    assert {r.time_ns: int(r.qc_bits) for r in masks.collect()} == {1: 9223372036854775809, None: 4}
    seen = spark.createDataFrame([(None, "s", "v")], "time_ns long, series_id string, variable string")
    assert qc.attach_masks(seen, masks, KEYS).first().mask == 0


def test_the_scan_gets_the_predicate(spark, rules, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.createDataFrame(ROWS, FACTS).write.parquet(f"{tmp_path}/f")
    plan = qc.select(spark.read.parquet(f"{tmp_path}/f"), rules.profiles["wxt"], DAY, DAY + 4, (("sensor", "wxt"),))._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(time_ns" in pushed and "LessThan(time_ns" in pushed and "EqualTo(sensor,wxt)" in pushed and "Or(" in pushed


def changed(*path, value):
    d = copy.deepcopy(RULES)
    at = d
    for p in path[:-1]:
        at = at[p]
    at[path[-1]] = value
    return d


V = ("profiles", "wxt", "variables", "temperature")


@pytest.mark.parametrize(
    "document",
    [
        changed("schema_version", value=2), changed("more", value=1), changed("flags", "physical_range", value={"bit": 0}), changed("flags", "physical_range", value={"bit": 64}),
        changed(*V, "checks", 0, "flag", value="nothing"), changed(*V, "checks", 1, "id", value="temp_missing"), changed(*V, "checks", 0, "args", value={"left": 1}), changed(*V, "checks", 1, "na_pass", value=False),
        changed(*V, "checks", 1, "args", value={"left": 3, "right": 1}), changed(*V, "checks", 1, "thresholds", value={"warning": 2}), changed(*V, "missing_values", value=[1, 1]), changed(*V, "missing_values", value=[float("nan")]),
        changed(*V, "where", "measurement", value="wind"), changed(*V, "missing_strings", value=["x"]), changed("profiles", "wxt", "variables", "clock", "checks", 0, "method", value="col_vals_between"),
        changed("pipelines", value={"p": {"stages": [1, 2]}}),
    ],
)
def test_invalid_rules(document):
    with pytest.raises(ConfigError):
        Rules.from_document(document)


def run_document(path, **more):
    d = {"schema_version": 1, "source": {"path": f"{path}/facts", "time": {"column": "time_ns"}, "observation_keys": list(KEYS)}, "quality": {"rules": "rules.yaml"}, "selection": {"start": T0, "end": T3}, "processing": {"period": "1d"}, "work_units": [{"id": "u1", "profile": "wxt", "filters": {"sensor": "wxt"}}], "output": {"root": f"{path}/out"}}
    return d | more


@pytest.mark.parametrize(
    "more",
    [
        {"selection": {"start": T3, "end": T0}}, {"selection": {"start": datetime(2025, 1, 1), "end": T3}}, {"processing": {"period": "2d"}}, {"work_units": [{"id": "../x", "profile": "wxt"}]},
        {"work_units": [{"id": "a", "profile": "wxt"}] * 2}, {"output": {"root": "/tmp/x/facts/deeper"}}, {"source": {"path": "/tmp/x/facts", "time": {"column": "t"}, "observation_keys": ["time_ns"]}}, {"extra": 1},
        {"output": {"root": "/tmp/x/out", "netcdf": {"site": "s", "instrument": "i"}}},
    ],
)
def test_invalid_runs(more):
    with pytest.raises(ConfigError):
        Run.from_document(run_document("/tmp/x", **more))


def test_runs_resume_and_report(spark, rules, tmp_path):
    later = [(r[0] + 86_400 * 10**9, *r[1:]) for r in ROWS[3:4]]
    spark.createDataFrame(ROWS + later, FACTS).write.parquet(f"{tmp_path}/facts")
    run = Run.from_document(run_document(tmp_path))
    made = runner.run_new(spark, rules, run, "r1")
    assert runner.totals(made, run) == {"rows_processed": 9, "findings": 8, "complete": 3, "empty": 1, "missing": 0}
    report = {r.check_id: r for r in runner.report(made, run).collect()}
    assert report["temp_physical"].units_failed == 2 and report["temp_physical"].units_tested == 6
    said = json.loads((tmp_path / "out/runs/r1/config/resolved.json").read_text())
    assert said["source"] == f"{tmp_path}/facts" and said["output"] == f"{tmp_path}/out"
    with pytest.raises(FileExistsError):
        runner.run_new(spark, rules, run, "r1")
    place = made.place(run.work_units[0], list(runner._periods(run))[0])
    made.files.delete(place)
    assert runner.totals(made, run)["missing"] == 1
    assert runner.totals(runner.resume(spark, rules, run, "r1"), run)["missing"] == 0
    before = sorted(map(str, spark.read.parquet(f"{place}/qc_flags").collect()))
    runner.recompile(made, run)
    assert sorted(map(str, spark.read.parquet(f"{place}/qc_flags").collect())) == before
    other = Rules.from_document(changed(*V, "checks", 1, "args", value={"left": 0, "right": 1}))
    assert config_hash(other, run, run.work_units[0]) != config_hash(rules, run, run.work_units[0])
    with pytest.raises(ValueError):
        runner.resume(spark, other, run, "r1")


def test_masks_in_one_exchange_are_those_of_findings(spark, rules):
    profile = rules.profiles["wxt"]
    rows = seen(spark, rules)
    rows = rows.unionByName(rows.filter("observed_value is not null").withColumn("observed_value", F.lit(1e6))).unionByName(rows.withColumn("time_ns", F.lit(None).cast("long")))
    joined = qc.attach_masks(rows, qc.compile_masks(qc.findings(rows, profile, rules), KEYS), KEYS)
    text = lambda df: sorted(str(sorted(r.asDict().items(), key=str)) for r in df.collect())
    assert text(qc.flagged(rows, profile, rules, KEYS)) == text(joined.select(*rows.columns, "mask", "qc_bits"))


def test_level1_files_hold_the_observations_of_each_day(spark, rules, tmp_path):
    ids = F.unhex(F.substring(F.sha2("series_id", 256), 1, 32))
    days = spark.createDataFrame([(t + d * 86_400 * 10**9, *rest) for d in (0, 2) for t, *rest in ROWS for _ in range(d // 2 + 1)], FACTS)
    days.withColumns({"series_id": ids, "vsn": F.lit("W1"), "instrument_id": F.lit("i")}).write.parquet(f"{tmp_path}/facts")
    document = run_document(tmp_path, output={"root": f"{tmp_path}/out", "netcdf": {"site": "s", "instrument": "i"}})
    document["work_units"] = [{"id": "u1", "profile": "wxt", "filters": {"sensor": "wxt", "vsn": "W1", "instrument_id": "i"}}]
    run = Run.from_document(document)
    made = runner.run_new(spark, rules, run, "r1")
    profile, rows, files = rules.profiles["wxt"], 0, []
    for p in times.iter_periods(run.start, run.end, run.period):
        marker = made.marker(run.work_units[0], p)
        path = f"{made.place(run.work_units[0], p)}/netcdf/{marker['netcdf']}"
        header, found = cdf.read_header(path), cdf.read(spark, path).collect()
        assert len(found) == marker["rows_processed"] and header["attributes"]["instrument_model"] == "wxt" and header["attributes"]["source_file_count"] == marker["input_files"]
        assert all(p.bounds[0] <= r.time_ns < p.bounds[1] for r in found)
        table = json.loads(header["variables"]["variable"]["attributes"]["code_table"])
        assert [table[str(i)]["name"] for i in range(len(table))] == [v.name for v in profile.variables]
        bits = {}
        if (kept := made.read("qc_flags", run.work_units[0], [p])) is not None:
            bits = {(r.time_ns, bytes(r.series_id), r.variable): int(r.qc_bits) for r in kept.collect()}
        for r in found:
            assert int(r.qc_bits) == bits.get((r.time_ns, bytes(r.series_id), table[str(r.variable)]["name"]), 0)
        assert [(r.variable, r.time_ns) for r in found] == sorted((r.variable, r.time_ns) for r in found)
        rows += len(found)
        files.append(path)
    assert rows == runner.totals(made, run)["rows_processed"] > 0 and len(set(files)) == len(files) > 1


def test_parts_of_a_run_from_the_command_line(spark, rules, tmp_path, capsys):
    import yaml

    spark.createDataFrame(ROWS, FACTS).write.parquet(f"{tmp_path}/facts")
    document = run_document(tmp_path)
    document["work_units"] = [{"id": u, "profile": "wxt"} for u in ("u1", "u2")]
    document["quality"] = {"rules": str(tmp_path / "rules.yaml")}
    (tmp_path / "rules.yaml").write_text(yaml.safe_dump(RULES))
    (tmp_path / "run.yaml").write_text(yaml.safe_dump(document))
    run = Run.read(str(tmp_path / "run.yaml"))
    at = lambda action, *more: cli.main(["qc", action, "--run", str(tmp_path / "run.yaml"), "--run-id", "r1", *more])
    assert at("run", "--work-unit", "u9") == 2 and at("run", "--work-unit", "u2") == 0
    made = runner.Store(spark, run.output, "r1")
    first = next(iter(times.iter_periods(run.start, run.end, run.period)))
    assert made.marker(run.work_units[0], first) is None and made.marker(run.work_units[1], first)
    assert at("resume") == 0 and made.marker(run.work_units[0], first)
    masks = lambda: sorted((r.time_ns, r.variable, int(r.qc_bits)) for r in made.read("qc_flags", run.work_units[0], [first]).collect())
    before = masks()
    made.files.delete(f"{made.place(run.work_units[0], first)}/qc_flags")
    assert at("compile", "--period", "never") == 2 and at("compile", "--period", first.id, "--work-unit", "u1") == 0 and masks() == before
    capsys.readouterr()
    assert at("report", "--format", "text") == 0
    said = capsys.readouterr().out.splitlines()
    assert said[0] == "run\tr1" and "variable\tbit\tflag_name\tcheck_id\tunits_tested\tunits_passed\tunits_failed\tfraction_failed" in said
    assert any(line.startswith("temperature\t0\tmissing_value\ttemp_missing\t10\t6\t4\t0.4") for line in said)


def test_source_is_checked_before_any_output(spark, rules, tmp_path):
    spark.createDataFrame(ROWS, FACTS).drop("value_string").write.parquet(f"{tmp_path}/facts")
    with pytest.raises(ValueError, match="lacks"):
        runner.run_new(spark, rules, Run.from_document(run_document(tmp_path)), "r1")
    assert not (tmp_path / "out").exists()


def test_level1(spark, rules):
    profile = rules.profiles["wxt"]
    rows = qc.attach_masks(seen(spark, rules), qc.compile_masks(qc.findings(seen(spark, rules), profile, rules), KEYS), KEYS)
    with pytest.raises(Exception, match="no code"):
        level1.with_codes(rows, {"wind": 0}).collect()
    day = Period(T0, datetime(2025, 1, 2, tzinfo=UTC))
    assert level1.file_name("neiu", "wxt536", "W08D", day) == "neiu.wxt536.W08D.native.a1.20250101T000000Z-20250102T000000Z.nc"
    with pytest.raises(ValueError):
        level1.file_name("s", "i", "v", Period(T0, T3))
    span = level1.coverage(rows).first()
    said = level1.attributes(rules, profile, day, (span.first_second, span.end_second))
    assert said["time_coverage_start"] == "2025-01-01T00:00:00Z" and said["time_coverage_duration"] == "PT1S" and said["flag_masks"] == "1 2 4 8"
    assert level1.attributes(rules, profile, day, None)["time_coverage_duration"] == "PT0S"
