"""``python -m tsforge.cli``: convert, inventory, backup, engine, qc validate, show, run, resume, compile and report. Findings are no failure."""

from __future__ import annotations

import argparse
import json
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tsforge.functions.identity import Registry
from tsforge.operators import inventory, store
from tsforge.operators.selection import Selection
from tsforge.plans import backup, export, runner
from tsforge.plans.qc_config import Rules, Run
from tsforge.sources import line_protocol, tables


def _json(path: str | None):
    if not path:
        return None
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def convert(spark: SparkSession, a) -> int:
    """UTC days of line protocol to facts, quarantine, series and catalogs."""
    selection = Selection.from_document(d) if (d := _json(a.selection)) else None
    registry = Registry.from_document(d, a.require_registry) if (d := _json(a.registry)) else Registry()
    allowed = tables.read_list(a.allow) if a.allow else None
    start, end = export.day_range(a.date, a.last_date)
    if a.input == "-":  # what is piped in is kept beside the dataset until it is published
        a.input = spool = f"{a.output}/_spool/{a.run_id}.lp"
        store.Files(spark).write_stream(spool, sys.stdin.buffer)
    points = line_protocol.read_files(spark, a.input, registry)
    print(json.dumps(export.export_days(points, a.output, a.run_id, start, end, selection, registry, allowed, a.on_existing), default=str))
    store.Files(spark).delete(f"{a.output}/_spool")
    return 0


def from_backup(spark: SparkSession, a) -> int:
    """UTC days of a backup's shards to facts, quarantine, series and catalogs."""
    selection = Selection.from_document(d) if (d := _json(a.selection)) else None
    registry = Registry.from_document(d) if (d := _json(a.registry)) else Registry()
    start, end = (t.date() for t in export.day_range(a.date, a.last_date))
    inspector = backup.Command(a.binary) if a.binary else None
    allowed = tables.read_list(a.allow) if a.allow else None
    found = backup.export_backup(spark, tables.load_backup(a.input, a.bucket), a.output, start, end, inspector, selection, registry, work=a.work, allowed_ids=allowed)
    print(json.dumps(found, default=str))
    return 0 if found["status"] == "complete" else 1


def from_engine(spark: SparkSession, a) -> int:
    """UTC days of a storage engine's folder to facts, quarantine, series and catalogs."""
    selection = Selection.from_document(d) if (d := _json(a.selection)) else None
    registry = Registry.from_document(d) if (d := _json(a.registry)) else Registry()
    start, end = (t.date() for t in export.day_range(a.date, a.last_date))
    allowed = tables.read_list(a.allow) if a.allow else None
    print(json.dumps(backup.export_engine(spark, a.input, a.bucket, a.output, a.run_id, start, end, selection, registry, a.on_existing, allowed), default=str))
    return 0


def index(spark: SparkSession, a) -> int:
    """Index dumps to an inventory of series and of sources that is kept and brought up to date; a broken dump is an error row."""
    sources = inventory.update(spark, a.input, f"{a.output}/_inventory")
    entries = inventory.entries(spark, f"{a.output}/_inventory")
    registry = Registry.from_document(d) if (d := _json(a.registry)) else Registry()
    keyed = entries.withColumns({"key": F.to_json(F.array_sort(F.map_entries("tags"))), "ordinal": F.col("source")})
    rolled = inventory.rollup(keyed, "measurement", "field", "key")
    tags = keyed.groupBy("key").agg(F.first("tags").alias("tags"))
    resolved = inventory.resolve(rolled.join(tags, "key"), registry).persist()
    who = ("instrument_id", "source", "confidence", "review_required", "vsn", "kind", "zone")
    store.write_csv(resolved.withColumn("tags", F.to_json("tags")).drop("key"), f"{a.output}/series", "measurement", "field", "tags")
    store.write_csv(inventory.instruments(resolved, *who), f"{a.output}/instruments", "instrument_id")
    store.write_csv(inventory.instrument_variables(resolved, "instrument_id"), f"{a.output}/instrument_variables", "instrument_id", "measurement", "field")
    store.write_csv(inventory.measurements(resolved), f"{a.output}/measurements", "measurement", "field")
    store.write_csv(inventory.status_counts(sources), f"{a.output}/status", "status")
    store.write_csv(sources.drop("source_id"), f"{a.output}/sources", "source")
    for name, column in (("family_measurements", "measurement"), ("family_instruments", "instrument_id")):
        store.write_lines(inventory.family(resolved, a.family, a.family_sensor, column), f"{a.output}/{name}")
    resolved.unpersist()
    return 0


def quality(spark: SparkSession, a) -> int:
    run = Run.read(a.run)
    rules = Rules.read(run.rules)
    if a.action == "validate":
        runner.validate(spark, rules, run)
    elif a.action == "show":
        print(runner.snapshot(run))
    elif a.action in ("run", "resume"):
        made = runner.run_new(spark, rules, run, a.run_id, [a.run, run.rules], a.work_unit) if a.action == "run" else runner.resume(spark, rules, run, a.run_id, a.work_unit)
        print(json.dumps(runner.totals(made, run)))
    else:
        made = runner.Store(spark, run.output, a.run_id)
        if a.action == "compile":
            runner.recompile(made, run, a.period, a.work_unit)
        elif a.format == "text":
            print(runner.report_text(made, run))
        elif (found := runner.report(made, run)) is not None:
            print(json.dumps([r.asDict() for r in found.collect()]))
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tsforge")
    sub = p.add_subparsers(required=True)
    c = sub.add_parser("convert")
    for name in ("--input", "--output", "--run-id", "--date"):
        c.add_argument(name, required=True)
    for name in ("--last-date", "--selection", "--registry", "--allow"):
        c.add_argument(name)
    c.add_argument("--on-existing", choices=("error", "skip"), default="error")
    c.add_argument("--require-registry", action="store_true")
    c.set_defaults(call=convert)
    b = sub.add_parser("backup")
    for name in ("--input", "--bucket", "--output", "--date"):
        b.add_argument(name, required=True)
    for name in ("--last-date", "--selection", "--registry", "--allow"):
        b.add_argument(name)
    b.add_argument("--work", help="a folder that all machines share, for what archives hold")
    b.add_argument("--binary", help="the storage engine's binary, to read shards with it instead")
    b.set_defaults(call=from_backup)
    e = sub.add_parser("engine")
    for name in ("--input", "--bucket", "--output", "--run-id", "--date"):
        e.add_argument(name, required=True)
    for name in ("--last-date", "--selection", "--registry", "--allow"):
        e.add_argument(name)
    e.add_argument("--on-existing", choices=("error", "skip"), default="skip")
    e.set_defaults(call=from_engine)
    i = sub.add_parser("inventory")
    for name in ("--input", "--output"):
        i.add_argument(name, required=True)
    i.add_argument("--registry")
    i.add_argument("--family", default="wxt.", help="prefix of the measurements to list")
    i.add_argument("--family-sensor", default="vaisala-wxt536", help="sensor whose rows belong to the family as well")
    i.set_defaults(call=index)
    q = sub.add_parser("qc")
    q.add_argument("action", choices=("validate", "show", "run", "resume", "compile", "report"))
    q.add_argument("--run", required=True)
    q.add_argument("--run-id", default="run-1")
    q.add_argument("--work-unit", action="append", help="only these (run, resume, compile)")
    q.add_argument("--period", action="append", help="only these ids (compile)")
    q.add_argument("--format", choices=("json", "text"), default="json", help="of the report")
    q.set_defaults(call=quality)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tsforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return a.call(spark, a)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
