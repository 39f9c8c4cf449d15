"""Exports of a storage backup: which shards a range needs, what each holds, and their points as one export.

A backup is a manifest and one archive for each shard. All shards that touch the
range and have no marker are one job. An archive is a compressed stream, so one
task takes its storage files out of it, to a folder that executors share; from
there the files are read by ranges of blocks (``sources.tsm``): footers tell
which measurements the selection wants, and blocks of others or of other times
are not read. All points are published as one export, catalogs are made once,
and then a marker for each shard says so: a shard with a marker of the same
identity is not read again, even if its archive is gone. A shard whose archive or
blocks are broken is an error row and stops no other.

An ``Inspector`` (as the storage engine's own binary) may stand in for the
reader of storage files; then a shard is one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import subprocess
import tarfile
import tempfile
from collections.abc import Iterable, Iterator
from datetime import UTC, date, datetime, timedelta
from pathlib import Path
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.functions import times
from tsforge.functions.identity import Registry
from tsforge.operators import ranges, store
from tsforge.operators.selection import Selection
from tsforge.plans import export
from tsforge.schema import IDENTIFIED_POINTS
from tsforge.sources import tables, tsm
from tsforge.sources.line_protocol import IDENTIFIED, batches_of, parse_series, parser_of, records

_INDEX_ROW = re.compile(tables.INDEX_ROW.replace("$", r"\Z"))

SHARD_POINTS = f"{IDENTIFIED_POINTS}, shard long, error string"
_SHARD_TYPES = pa.schema([*IDENTIFIED, ("shard", pa.int64()), ("error", pa.string())])


class Inspector(Protocol):
    """What reads storage files: the index of one, and a range of an engine as line protocol."""

    def index(self, path: str) -> Iterable[str]: ...

    def lines(self, engine: str, bucket: str, measurements: list[str], start: datetime, end: datetime) -> Iterable[bytes]: ...


class Command:
    """The storage engine's own binary, that must be on every machine."""

    def __init__(self, binary: str):
        self.binary = binary

    def _run(self, command: list[str]) -> Iterator[bytes]:
        with subprocess.Popen(command, stdout=subprocess.PIPE) as process:
            yield from process.stdout
            if process.wait():
                raise OSError(f"{' '.join(command[:3])} failed with {process.returncode}")

    def index(self, path):
        return (line.decode() for line in self._run([self.binary, "inspect", "dump-tsm", "--index", "--file-path", path]))

    def lines(self, engine, bucket, measurements, start, end):
        return self._run(tables.export_command(self.binary, engine, bucket, measurements, start, end))


def discover(lines: Iterable[str], selection: Selection | None) -> tuple[list[str], int]:
    """The measurements of an index that a selection wants, and how many entries were read; a bad row is an error."""
    wanted, series, n = set(), {}, 0
    for line in lines:
        if not re.match(r"\s*\d+\t", line):
            continue
        row = _INDEX_ROW.match(line.rstrip("\r\n"))
        if not row:
            raise ValueError(f"not an index row: {line!r}")
        n += 1
        key, field = row[5], row[6]
        if (key, field) not in series:
            measurement, tags = parse_series(key)
            series[key, field] = True
            if selection is None or selection.takes(measurement, field, tags):
                wanted.add(measurement)
    return sorted(wanted), n


def _inspected(shard: dict, bucket: str, inspector: Inspector, selection: Selection | None, registry: Registry | None, work: str | None):
    """Batches of a shard's points through an inspector; the staged files go when they are read, or when that fails."""
    with tempfile.TemporaryDirectory(prefix=f"shard-{shard['id']}-", dir=work) as folder:
        staged = tables.stage_archive(shard["path"], f"{folder}/data", f"{bucket}/")
        measurements, _ = discover((line for path in staged for line in inspector.index(path)), selection)
        if measurements:
            start, end = (datetime.fromisoformat(shard[k]) for k in ("start", "end"))
            for batch in batches_of(records(inspector.lines(folder, bucket, measurements, start, end)), parser_of(registry)()):
                if (batch.column("time_ns").to_numpy() < times.to_ns(start)).any():
                    raise ValueError("a point precedes the range")
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, shard["id"])), pa.nulls(n, pa.string())], schema=_SHARD_TYPES)


def _a_task_each(spark: SparkSession, texts: list[str], name: str) -> DataFrame:
    """Texts by ranges, one to each: dealt in turn, as ``repartition`` does it, few rows may well be one task's."""
    return spark.createDataFrame([(t,) for t in texts], f"{name} string").repartitionByRange(max(1, len(texts)), name)


def _shard_rows(spark: SparkSession, shards: list[dict]) -> DataFrame:
    """A task for each shard."""
    return _a_task_each(spark, [json.dumps(s) for s in shards], "shard")


def _said(error: Exception) -> str:
    return str(error).split("\n")[0] or type(error).__name__


def _through(spark, shards, bucket, inspector, selection, registry, work) -> DataFrame:
    def run(batches):
        for batch in batches:
            for text in batch.column("shard").to_pylist():
                shard = json.loads(text)
                try:
                    yield from _inspected(shard, bucket, inspector, selection, registry, work)
                except Exception as e:  # noqa: BLE001 - what a shard's tools raise is reported, and the others go on
                    yield pa.RecordBatch.from_pylist([{"shard": shard["id"], "error": _said(e)}], schema=_SHARD_TYPES)

    return _shard_rows(spark, shards).mapInArrow(run, SHARD_POINTS)


def staged(spark: SparkSession, shards: list[dict], bucket: str, folder: str) -> DataFrame:
    """The storage files of shards (id, path), taken out of their archives into a shared folder: shard, file, error."""
    schema = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("error", pa.string())])

    def run(batches):
        for batch in batches:
            for text in batch.column("shard").to_pylist():
                shard = json.loads(text)
                try:
                    # a folder of this attempt, so a task that runs twice never meets its other self
                    own = tempfile.mkdtemp(prefix=f"shard-{shard['id']}-", dir=folder)
                    rows = [{"shard": shard["id"], "file": f} for f in tables.stage_archive(shard["path"], own, f"{bucket}/")]
                except Exception as e:  # noqa: BLE001 - as above
                    rows = [{"shard": shard["id"], "error": _said(e)}]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return store.kept(_shard_rows(spark, shards).mapInArrow(run, "shard long, file string, error string"), "staged")


def _measurements(selection: Selection | None):
    """Index rows of series (measurement, series_key, field) to the measurements of which any series is wanted."""

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "measurement", "series_key", "field")))
            found = {(shard, m) for shard, m, key, field in rows if selection is None or selection.takes(m, field, parse_series(key)[1])}
            yield pa.RecordBatch.from_pylist([{"shard": s, "measurement": m} for s, m in found], schema=pa.schema([("shard", pa.int64()), ("measurement", pa.string())]))

    return run


def shard_points(spark: SparkSession, shards: list[dict], bucket: str, folder: str, selection: Selection | None = None, registry: Registry | None = None) -> DataFrame:
    """The points of shards (id, path, start and end as text), with ``shard`` and ``error``; staged in a shared folder.

    As the storage engine exports whole measurements, all series of a measurement
    come if the selection takes any of them; what becomes of each is for ``ingest``.
    """
    files = staged(spark, shards, bucket, folder)
    bounds = [(s["id"], *(times.to_ns(datetime.fromisoformat(s[k])) for k in ("start", "end"))) for s in shards]
    clip = spark.createDataFrame(bounds, "shard long, low long, high long")
    low, high = min(b[1] for b in bounds), max(b[2] for b in bounds)
    blocks = tsm.index(spark, files.filter("file is not null"), low, high)
    owned = store.kept(blocks.join(files.select("file", "shard"), "file"), "index")
    inside = owned.filter("error is null").join(F.broadcast(clip), "shard").filter("minimum_time < high and maximum_time >= low").drop("low", "high")
    wanted = inside.select("shard", "measurement", "series_key", "field").distinct().mapInArrow(_measurements(selection), "shard long, measurement string").distinct()
    chosen = store.kept(inside.join(wanted, ["shard", "measurement"], "left_semi").drop("shard").unionByName(owned.filter("error is not null").drop("shard")), "chosen")
    found = tsm.points(spark, chosen, low, high, registry, strict=False).join(files.filter("file is not null").select("file", "shard"), "file").drop("file")
    clipped = found.join(F.broadcast(clip), "shard").filter("error is not null or time_ns >= low and time_ns < high").drop("low", "high")
    columns = [*IDENTIFIED.names, "shard", "error"]
    nothing = [F.lit(None).cast(spark.createDataFrame([], SHARD_POINTS).schema[c].dataType).alias(c) for c in IDENTIFIED.names]
    return clipped.select(*columns).unionByName(files.filter("error is not null").select(*nothing, "shard", "error"))


def _marker(root: str, shard: dict, identity: dict) -> str:
    """A marker's path, from the shard, its clipped range and what the export is made with."""
    said = json.dumps([shard["id"], Path(shard["path"]).name, shard["size"], shard["start"], shard["end"], identity], sort_keys=True)
    return f"{root}/_shards/{shard['id']}-{hashlib.sha256(said.encode()).hexdigest()[:16]}.json"


def shards_in(spark: SparkSession, backup: dict, start: date, end: date) -> tuple[list[dict], list[str]]:
    """The shards that touch [start, end), clipped to it, and the days that none covers."""
    rows = [(s["id"], s["path"], s["size"], times.as_utc(s["start"]).replace(tzinfo=None), times.as_utc(s["end"]).replace(tzinfo=None)) for s in backup["shards"]]
    every = spark.createDataFrame(rows, "id long, path string, size long, start timestamp_ntz, end timestamp_ntz")
    touched = ranges.overlapping(every, "start", "end", *(F.lit(d.isoformat()).cast("timestamp_ntz") for d in (start, end)))
    days = ranges.expanded(touched.select(F.col("start").cast("date").alias("low"), F.date_add(F.expr("`end` - interval 1 microsecond").cast("date"), 1).alias("high")), "low", "high")
    wanted = spark.createDataFrame([(start + timedelta(days=i),) for i in range((end - start).days)], "day date")
    missing = sorted(str(r.day) for r in ranges.missing_days(wanted, days).collect())
    found = [r.asDict() | {"start": f"{r.start.isoformat()}+00:00", "end": f"{r.end.isoformat()}+00:00"} for r in touched.orderBy("start", "id").collect()]
    return found, missing


_COUNTS = ("parsed_rows", "output_rows", "quarantined_rows")


def export_backup(
    spark: SparkSession, backup: dict, root: str, start: date, end: date, inspector: Inspector | None = None, selection: Selection | None = None,
    registry: Registry | None = None, on_existing: str = "skip", work: str | None = None, allowed_ids: set[str] | None = None,
) -> dict:
    """Publishes the days [start, end) of a backup's shards in one export; broken shards are errors of the manifest.

    ``work`` is where archives are staged: a folder that executors share, unless an inspector reads them.
    """
    files = store.Files(spark)
    source = {"snapshot": backup.get("snapshot", ""), "bucket": backup["bucket_id"]}
    identity = export.identity_of(selection, registry, source)
    shards, missing = shards_in(spark, backup, start, end)
    markers = {s["id"]: _marker(root, s, identity) for s in shards}
    results = {s["id"]: json.loads(files.read_text(markers[s["id"]])) | {"resumed": True} for s in shards if files.exists(markers[s["id"]])}
    errors = [{"source": d, "error": "no shard of the backup covers this day"} for d in missing]
    pending = [s for s in shards if s["id"] not in results]
    published, review = 0, any(r["requires_review"] for r in results.values())
    if pending:
        run_id = "backup-" + hashlib.sha256(json.dumps(sorted(markers[s["id"]] for s in pending)).encode()).hexdigest()[:16]
        low, high = (datetime.fromisoformat(f([s[k] for s in pending])) for f, k in ((min, "start"), (max, "end")))
        with tempfile.TemporaryDirectory(prefix="shards-", dir=work or (None if inspector else store.mounted(spark, "shards"))) as folder:
            made_of = (spark, pending, backup["bucket_id"])
            points = _through(*made_of, inspector, selection, registry, work) if inspector else shard_points(*made_of, folder, selection, registry)
            made = export.export_days(points, root, run_id, low, high, selection, registry, allowed_ids, on_existing, source, parts="shard")
        published, review = made["published_rows"], review or made["requires_review"]
        for s in pending:
            if s["id"] in made["failed"]:
                errors.append({"source": Path(s["path"]).name, "error": made["failed"][s["id"]]})
                continue
            counts = made["parts"].get(s["id"], dict.fromkeys(_COUNTS, 0))
            said = {"shard": s["id"], "run_id": run_id, **counts, "requires_review": export.review(counts["quarantined_rows"], made["metadata_conflicts"])}
            files.write_text(markers[s["id"]], json.dumps(said, sort_keys=True, indent=1))
            results[s["id"]] = said | {"resumed": False}
    every = [results[s["id"]] for s in shards if s["id"] in results]
    manifest = {k: sum(r[k] for r in every) for k in _COUNTS} | {"published_rows": published, "requested_days": (end - start).days, "shards": every, "errors": errors}
    manifest |= {"status": "incomplete" if errors else "complete", "identity": identity, "requires_review": review}
    said = json.dumps(manifest, sort_keys=True, indent=1)
    files.write_text(f"{root}/_exports/backup-{hashlib.sha256(said.encode()).hexdigest()[:16]}.json", said)
    return manifest


def archive(spark: SparkSession, wanted: list[tuple[str, str, str]]) -> None:
    """Archives of folders: (archive, root, folder below it that is taken), a task each; an archive appears when it is whole."""

    def run(batches):
        for batch in batches:
            for text in batch.column("said").to_pylist():
                path, root, folder = json.loads(text)
                part = f"{path}.{os.getpid()}.part"
                with tarfile.open(part, "w:gz", compresslevel=1) as out:
                    out.add(f"{root}/{folder}", arcname=folder)
                os.replace(part, path)
        yield from ()

    rows = _a_task_each(spark, [json.dumps(w) for w in wanted], "said")
    rows.mapInArrow(run, "said string").write.format("noop").mode("overwrite").save()


def engine_points(spark: SparkSession, engine: str, bucket: str, start: datetime, end: datetime, selection: Selection | None = None, registry: Registry | None = None) -> DataFrame:
    """The points of a storage engine's folder in [start, end): whole measurements of which the selection takes any series."""
    low, high = times.to_ns(start), times.to_ns(end)
    blocks = store.kept(tsm.index(spark, f"{engine}/data/{bucket}", low, high), "index")
    if broken := blocks.filter("error is not null").select("file", "error").head(1):
        raise ValueError(f"{broken[0].file}: {broken[0].error}")
    series = blocks.select(F.lit(0).cast("long").alias("shard"), "measurement", "series_key", "field").distinct()
    wanted = series.mapInArrow(_measurements(selection), "shard long, measurement string").select("measurement").distinct()
    chosen = store.kept(blocks.join(wanted, "measurement", "left_semi"), "chosen")
    return tsm.points(spark, chosen, low, high, registry).select(*IDENTIFIED.names)


def export_engine(
    spark: SparkSession, engine: str, bucket: str, root: str, run_id: str, start: date, end: date, selection: Selection | None = None, registry: Registry | None = None,
    on_existing: str = "skip", allowed_ids: set[str] | None = None,
) -> dict:
    """Publishes the days [start, end) of a storage engine's folder (``data/<bucket>`` below it), as one export."""
    low, high = (datetime.combine(d, datetime.min.time(), UTC) for d in (start, end))
    points = engine_points(spark, engine, bucket, low, high, selection, registry)
    return export.export_days(points, root, run_id, low, high, selection, registry, allowed_ids, on_existing, {"bucket": bucket})
