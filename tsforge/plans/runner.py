"""Runs: every period of every work unit, once; resumed, recompiled, reported.

All pending periods of a work unit are one job over the source, partitioned by
period. Each period's tables are then renamed to its place with their marker.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge import __version__
from tsforge.functions import times
from tsforge.operators.store import OPTIONS, Files, Staged, mounted
from tsforge.plans import level1, qc
from tsforge.plans.qc_config import Rules, Run, WorkUnit, config_hash
from tsforge.sources.tables import read_facts


class Store:
    """The folder of a run: run.json, then periods/<work unit>/<period id>/."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.files, self.run_id = spark, Files(spark), run_id
        self.path = f"{root}/runs/{run_id}"

    def place(self, unit: WorkUnit, period: times.Period) -> str:
        return f"{self.path}/periods/{unit.id}/{period.id}"

    def marker(self, unit: WorkUnit, period: times.Period) -> dict | None:
        path = f"{self.place(unit, period)}/success.json"
        return json.loads(self.files.read_text(path)) if self.files.exists(path) else None

    def read(self, name: str, unit: WorkUnit, periods: list[times.Period]) -> DataFrame | None:
        """A table of complete periods; those without rows have no folder of it."""
        paths = [f"{self.place(unit, p)}/{name}" for p in periods if self.marker(unit, p)]
        paths = [p for p in paths if self.files.exists(p)]
        empty = f"{self.path}/_empty/{name}"
        return self.spark.read.parquet(*paths, *([empty] if self.files.exists(empty) else [])) if paths or self.files.exists(empty) else None


def _identity(rules: Rules, run: Run) -> dict:
    return {u.id: config_hash(rules, run, u) for u in run.work_units}


def _periods(run: Run) -> list[times.Period]:
    return list(times.iter_periods(run.start, run.end, run.period))


def _facts(spark: SparkSession, run: Run) -> tuple[DataFrame, tuple[str, ...]]:
    """The source with its time as ``time_ns``, whatever unit it was stored in."""
    facts = read_facts(spark, run.source, run.hive, run.union_by_name)
    kind = dict(facts.dtypes)[run.time_column]
    if run.time_column != "time_ns":
        t = F.col(run.time_column)
        epoch = F.lit(0).cast("timestamp")
        facts = facts.withColumn("time_ns", t if kind == "bigint" else F.unix_micros(t.cast("timestamp")) * 1000 if kind == "timestamp" else F.timestamp_diff("MICROSECOND", epoch, t) * 1000)
    return facts, tuple("time_ns" if k == run.time_column else k for k in run.keys)


def validate(spark: SparkSession, rules: Rules, run: Run) -> None:
    """Everything that can be checked without a job."""
    facts, keys = _facts(spark, run)
    for u in run.work_units:
        if u.profile not in rules.profiles:
            raise ValueError(f"no such profile: {u.profile}")
        qc.validate_source(facts, rules.profiles[u.profile], keys, u.filters)


def snapshot(run: Run) -> str:
    """The run as it was understood, with all paths absolute."""
    return json.dumps(asdict(run), default=str, sort_keys=True, indent=1)


def run_new(spark: SparkSession, rules: Rules, run: Run, run_id: str, documents: list[str] = (), units: list[str] | None = None) -> Store:
    """A run of its own id; ``documents`` are local files to keep beside it as they were."""
    chosen(run, units)
    validate(spark, rules, run)
    store = Store(spark, run.output, run_id)
    if store.files.exists(f"{store.path}/run.json"):
        raise FileExistsError(f"the run {run_id} exists")
    for path in documents:
        store.files.write_text(f"{store.path}/config/{Path(path).name}", Path(path).read_text(encoding="utf-8"))
    store.files.write_text(f"{store.path}/config/resolved.json", snapshot(run))
    store.files.write_text(f"{store.path}/run.json", json.dumps(_identity(rules, run), sort_keys=True))
    return resume(spark, rules, run, run_id, units)


def marks(observations: DataFrame, found: DataFrame, *by: str) -> DataFrame:
    """What markers say of each period: rows, findings, and the input files as a number and a fingerprint."""
    files = F.sort_array(F.collect_set("_source_file"))
    seen = observations.groupBy(*by).agg(F.count("*").alias("rows_processed"), files.alias("_files"))
    said = seen.select(*by, "rows_processed", F.size("_files").alias("input_files"), F.sha2(F.array_join("_files", "\n"), 256).alias("input_fingerprint"))
    counted = found.groupBy(*by).agg(F.count("*").alias("findings"))
    return said.join(counted, list(by), "left").withColumn("findings", F.coalesce("findings", F.lit(0)).cast("long"))


_NOTHING = {"rows_processed": 0, "findings": 0, "input_files": 0, "input_fingerprint": hashlib.sha256(b"").hexdigest()}


def chosen(run: Run, units: list[str] | None) -> list[WorkUnit]:
    """The work units of a run, or those named."""
    if units and (unknown := set(units) - {u.id for u in run.work_units}):
        raise ValueError(f"no such work units: {sorted(unknown)}")
    return [u for u in run.work_units if not units or u.id in units]


def resume(spark: SparkSession, rules: Rules, run: Run, run_id: str, units: list[str] | None = None) -> Store:
    """Works on the periods without a marker, of all work units or those named; the configuration must be that of the run."""
    store = Store(spark, run.output, run_id)
    if json.loads(store.files.read_text(f"{store.path}/run.json")) != _identity(rules, run):
        raise ValueError("the configuration is not that of the run")
    facts, keys = _facts(spark, run)
    for unit in chosen(run, units):
        profile, said = rules.profiles[unit.profile], config_hash(rules, run, unit)
        todo = {p.bounds[0]: p for p in _periods(run) if not store.marker(unit, p)}
        if not todo:
            continue
        first, past = min(todo), max(p.bounds[1] for p in todo.values())
        period = times.period_of(F.col("time_ns"), run.start, run.end, run.period)["start"]
        selected = qc.select(facts, profile, first, past, unit.filters).withColumn("period", period)
        if len(todo) < sum(first <= p.bounds[0] < past for p in _periods(run)):
            selected = selected.filter(F.col("period").isin(sorted(todo)))
        stage = f"{store.path}/periods/_staging/{unit.id}-{uuid.uuid4().hex}"
        # written once: what follows reads it several times, and a lost executor takes nothing of it away
        qc.normalize(selected, profile, keys, "_source_file", "period").write.options(**OPTIONS).parquet(f"{stage}/observations")
        observations = spark.read.parquet(f"{stage}/observations")
        plain = observations.drop("_source_file")

        def staged(name: str, rows: DataFrame) -> DataFrame:
            rows.write.options(**OPTIONS).partitionBy("period").parquet(f"{stage}/{name}")
            if not store.files.exists(f"{store.path}/_empty/{name}"):
                rows.drop("period").limit(0).coalesce(1).write.mode("overwrite").parquet(f"{store.path}/_empty/{name}")
            return spark.read.schema(rows.schema).parquet(f"{stage}/{name}")

        found = staged("findings", qc.findings(plain, profile, rules, run_id, unit.id))
        masks = staged("qc_flags", qc.compile_masks(found, (*keys, "period")).drop("mask"))
        known = {r["period"]: r.asDict() for r in marks(observations, found, "period").collect()}
        results = qc.check_results(plain, profile, rules, "period", config_hash=said)
        # checks are reported of periods without rows as well
        without = sorted(set(todo) - set(known))
        nothing = qc.check_results(plain.limit(0), profile, rules, config_hash=said)
        staged("check_results", results.unionByName(nothing.withColumn("period", F.explode(F.array(*map(F.lit, without)).cast("array<bigint>")))))
        markers = {start: {"config_hash": said, "period": p.id} | _NOTHING | {k: v for k, v in known.get(start, {}).items() if k != "period"} for start, p in todo.items()}
        made = _level1(store, rules, run, unit, todo, markers, plain, masks, keys) if run.netcdf else {}
        for start, p in todo.items():
            _publish(store, unit, p, stage, markers[start], made.get(start))
        store.files.delete(stage)
    return store


def _level1(store: Store, rules: Rules, run: Run, unit: WorkUnit, todo: dict[int, times.Period], markers: dict[int, dict], observations: DataFrame, masks: DataFrame, keys: tuple[str, ...]) -> dict[int, str]:
    """The files of all pending periods, in one job, in a folder that executors share; their paths by period."""
    profile, (site, instrument) = rules.profiles[unit.profile], run.netcdf
    on = [*keys, "variable", "period"]
    flagged = observations.join(masks.select(*on, "qc_bits"), on, "left").withColumns({"qc_bits": F.coalesce("qc_bits", F.lit(0).cast("decimal(20,0)")), "period": F.col("period").cast("string")})
    spans = {r.period: (r.first_second, r.end_second) for r in level1.coverage(observations, "period").collect()}
    folder, filters = mounted(store.spark, "level1"), dict(unit.filters)
    paths, said = {}, {}
    for start, p in todo.items():
        span = spans.get(start)
        if span and not p.bounds[0] <= span[0] * times.SECOND <= span[1] * times.SECOND <= p.bounds[1]:
            raise ValueError(f"observations outside {p.id}")
        paths[str(start)] = f"{folder}/{start}/{level1.file_name(site, instrument, filters['vsn'], p)}"
        moment = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
        said[str(start)] = {
            "title": f"{instrument} native level 1 observations", "Conventions": "CF-1.10, ACDD-1.3", "source_snapshot": run.source, "source_dataset_fingerprint": markers[start]["input_fingerprint"],
            "source_file_count": np.int64(markers[start]["input_files"]), "qaqc_rule_fingerprint": markers[start]["config_hash"], "aggregation_rule_fingerprint": "not_applicable",
            "processing_software_version": __version__, "site_id": site, "vsn": filters["vsn"], "instrument_id": filters["instrument_id"], "instrument_model": filters["sensor"], "run_id": store.run_id,
            "work_unit_id": unit.id, "nominal_period_start": moment(p.start), "nominal_period_end": moment(p.end), **level1.attributes(rules, profile, p, span),
        }
    rows = level1.write_files(flagged, "period", rules, profile, keys, paths, said)
    if wrong := [p.id for start, p in todo.items() if rows[str(start)] != markers[start]["rows_processed"]]:
        raise OSError(f"files that don't hold what was observed: {wrong}")
    return {int(start): path for start, path in paths.items()}


def _publish(store: Store, unit: WorkUnit, period: times.Period, stage: str, marker: dict, file: str | None) -> None:
    ready = Staged(store.spark, store.place(unit, period))
    for name in ("findings", "qc_flags", "check_results"):
        if store.files.exists(f"{stage}/{name}/period={period.bounds[0]}"):
            store.files.rename(f"{stage}/{name}/period={period.bounds[0]}", f"{ready.path}/{name}")
    if file:
        store.files.put(file, f"{ready.path}/netcdf/{Path(file).name}", move=True)
        marker = marker | {"netcdf": Path(file).name}
    ready.publish(marker)


def recompile(store: Store, run: Run, periods: list[str] | None = None, units: list[str] | None = None) -> None:
    """The masks of complete periods again, from their findings, in one job: of all, or of the period ids and work units named."""
    keys = tuple("time_ns" if k == run.time_column else k for k in run.keys)
    every = _periods(run)
    if periods and (unknown := set(periods) - {p.id for p in every}):
        raise ValueError(f"no such periods: {sorted(unknown)}")
    places = [store.place(u, p) for u in chosen(run, units) for p in every if (not periods or p.id in periods) and store.marker(u, p)]
    paths = [p for x in places if store.files.exists(p := f"{x}/findings")]
    if not paths:
        return
    place = F.regexp_extract("_metadata.file_path", r"/periods/([^/]+/[^/]+)/findings/", 1)
    fresh = f"{store.path}/_recompiled-{uuid.uuid4().hex}"
    masks = qc.compile_masks(store.spark.read.parquet(*paths).withColumn("place", place), (*keys, "place")).drop("mask")
    masks.withColumn("place", F.replace("place", F.lit("/"), F.lit(","))).write.options(**OPTIONS).partitionBy("place").parquet(fresh)
    for name in store.files.names(fresh):
        if name.startswith("place="):
            old = f"{store.path}/periods/{name.removeprefix('place=').replace(',', '/')}/qc_flags"
            store.files.delete(old)
            store.files.rename(f"{fresh}/{name}", old)
    store.files.delete(fresh)


def report(store: Store, run: Run) -> DataFrame | None:
    """The results of all complete periods and work units."""
    parts = [r for u in run.work_units if (r := store.read("check_results", u, _periods(run))) is not None]
    union = None
    for p in parts:
        union = p if union is None else union.unionByName(p)
    return None if union is None else qc.report(union)


def tally(marked: DataFrame) -> DataFrame:
    """Rows, findings and periods of a table of markers: how many are there, and how many of them are empty."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return marked.agg(total("rows_processed"), total("findings"), F.count("*").alias("complete"), F.count_if(F.col("rows_processed") == 0).alias("empty"))


def totals(store: Store, run: Run) -> dict[str, int]:
    """Rows and findings of complete periods, and how many periods are complete, empty, or missing."""
    found = [store.marker(u, p) for u in run.work_units for p in _periods(run)]
    done = [(m["rows_processed"], m["findings"]) for m in found if m]
    summed = tally(store.spark.createDataFrame(done, "rows_processed long, findings long")).first().asDict()
    return summed | {"missing": len(found) - len(done)}


def report_text(store: Store, run: Run) -> str:
    """A report for people: the run's totals, then a line for each check with tabs between."""
    lines = [f"run\t{store.run_id}", *(f"{k}\t{v}" for k, v in totals(store, run).items())]
    columns = ("variable", "bit", "flag_name", "check_id", "units_tested", "units_passed", "units_failed", "fraction_failed")
    found = report(store, run)
    rows = [] if found is None else found.select(*columns).collect()
    said = ["\t".join(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows]
    return "\n".join([*lines, "", "\t".join(columns), *said])
