"""Exports: a range of days of line protocol to a dataset, resumable partition by partition.

All days and files of a range are one Spark job. The audit table ``_partitions``
has a row for each (sensor, vsn, instrument_id, date, variable) that was
published, with the identity it was made with; it answers what is complete, and
manifests and catalogs are rolled up from it without reading a fact again.

A run first writes its points and its plan (the rows that the audit is to get)
under ``_staging``. Facts replace what their partitions held, then come series
and quarantine, and at last the plan is renamed into the audit. A run that was
cut short anywhere before that has left facts that no audit knows: the next run
finds its plan, takes those partitions away, and a repeated run gives the same
rows as one that was never cut. One export at a time may write to a dataset.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge import __version__
from tsforge.functions import times
from tsforge.functions.identity import Registry
from tsforge.operators import catalog, ingest, store
from tsforge.operators.selection import Selection

STORAGE_VERSION = 4
CATALOGS = {
    "sensors": (catalog.sensors, ("sensor",)), "instruments": (catalog.instruments, ("sensor", "vsn", "instrument_id")),
    "variables": (catalog.variables, ("sensor", "measurement", "field")), "instrument_variables": (catalog.instrument_variables, ("sensor", "vsn", "instrument_id", "measurement", "field")),
}


def identity_of(selection: Selection | None, registry: Registry | None, source: dict[str, str] | None = None) -> dict[str, str]:
    """What a partition is made with; a dataset, and each partition of it, has one. ``source`` may name what was read (snapshot, bucket, exporter)."""
    own = {"selection": selection.fingerprint if selection else "", "registry": (registry or Registry()).fingerprint, "storage": str(STORAGE_VERSION), "engine": __version__}
    if clash := own.keys() & (source or {}).keys() | set(store.FACT_KEYS) & (source or {}).keys():
        raise ValueError(f"reserved names: {sorted(clash)}")
    return own | (source or {})


def partitions(spark: SparkSession, root: str) -> DataFrame | None:
    """The audit table, if anything was published yet."""
    return spark.read.option("basePath", f"{root}/_partitions").parquet(f"{root}/_partitions/*").drop("run") if store.Files(spark).names(f"{root}/_partitions") else None


def manifests(spark: SparkSession, root: str) -> DataFrame | None:
    """What is in each complete partition, with the identity it was made with."""
    known = partitions(spark, root)
    if known is None:
        return None
    keys = ["sensor", "vsn", "instrument_id", "date"]
    made = [c for c in known.columns if c not in (*keys, "measurement", "field", "value_type", "rows", "minimum_time", "maximum_time")]
    return catalog.partition_manifests(known).join(known.groupBy(*keys).agg(*(F.max(c).alias(c) for c in made)), keys).withColumn("status", F.lit("complete"))


def recover(spark: SparkSession, root: str) -> int:
    """Takes away the partitions that runs which were cut short have left, and what they staged; how many partitions."""
    files, gone = store.Files(spark), 0
    known = partitions(spark, root)
    keys = ["sensor", "vsn", "instrument_id", "date"]
    for run in files.names(f"{root}/_staging"):
        if files.exists(f"{root}/_staging/{run}/plan/_SUCCESS"):
            left = spark.read.parquet(f"{root}/_staging/{run}/plan").select(*keys).distinct()
            left = left if known is None else left.join(known, keys, "left_anti")
            for r in left.toLocalIterator():
                files.delete(store.partition_path(spark, root, {"sensor": r.sensor, "vsn": r.vsn, "instrument": r.instrument_id, "date": r.date}))
                gone += 1
        files.delete(f"{root}/_staging/{run}")
    return gone


def export_days(
    points: DataFrame, root: str, run_id: str, start: datetime, end: datetime, selection: Selection | None = None, registry: Registry | None = None,
    allowed_ids: set[str] | None = None, on_existing: str = "error", source: dict[str, str] | None = None, parts: str | None = None,
) -> dict:
    """Publishes the points of [start, end) and returns the export's manifest.

    Points may come from parts (a column's name) that can fail: a row with an
    ``error`` takes all rows of its part out, and the manifest says which parts
    failed and what each of the others gave.
    """
    spark, files = points.sparkSession, store.Files(points.sparkSession)
    identity = identity_of(selection, registry, source)
    store.guard_identity(spark, root, identity)
    recover(spark, root)
    stage = f"{root}/_staging/{run_id}"
    # written once: the points are parsed in Python, and nothing below depends on where they came from
    ingest.classify(ingest.identified(points, registry), times.to_ns(start), times.to_ns(end), selection, allowed_ids).write.options(**store.OPTIONS).parquet(f"{stage}/points")
    done, said = spark.read.parquet(f"{stage}/points"), {}
    if parts:
        failed = {r[0]: r[1] for r in done.filter("error is not null").groupBy(parts).agg(F.min("error")).collect()}
        done = done.filter(~F.col(parts).isin([*failed])) if failed else done
        counts = {r[parts]: r.asDict() for r in ingest.summary(done, False, parts).collect()}
        said = {"parts": {k: {c: n for c, n in row.items() if c != parts} for k, row in counts.items()}, "failed": failed}
    facts = ingest.facts_of(done).withColumns({"instrument": F.col("instrument_id"), "date": F.date_format(times.date_of(F.col("time_ns")), "yyyy-MM-dd")})
    known, fresh = partitions(spark, root), facts
    if known is not None:
        finished = known.select("sensor", "vsn", F.col("instrument_id").alias("instrument"), "date", *identity).distinct()
        fresh = store.unfinished(facts, finished, identity, on_existing)
    made = {"run_id": F.lit(run_id), **{k: F.lit(v) for k, v in identity.items()}}
    catalog.partition_variables(fresh).withColumn("date", F.date_format("date", "yyyy-MM-dd")).withColumns(made).write.options(**store.OPTIONS).parquet(f"{stage}/plan")
    plan = spark.read.parquet(f"{stage}/plan")
    published = plan.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if published:
        store.write_facts(fresh.drop("instrument", "date"), root)
        kept = done.filter(F.col("disposition") == ingest.OUTPUT)
        tags = kept.groupBy("series_id").agg(F.first("tags").alias("tags"))
        store.write_series(catalog.series(kept, "measurement", "sensor", "vsn", "instrument_id", "identity_source").join(tags, "series_id"), root, run_id)
    store.write_quarantine(ingest.quarantine_of(done), root, run_id)
    manifest = rollup(ingest.summary(done), start, end).first().asDict()
    if published:
        files.rename(f"{stage}/plan", f"{root}/_partitions/run={run_id}")  # last: what it names is there
    manifest |= said | {"run_id": run_id, "published_rows": published, "skipped_existing_rows": manifest["output_rows"] - published, "identity": identity, "metadata_conflicts": write_catalogs(spark, root)}
    manifest["requires_review"] = review(manifest["quarantined_rows"], manifest["metadata_conflicts"])
    files.write_text(f"{root}/_exports/{run_id}.json", json.dumps(manifest, default=str, sort_keys=True, indent=1))
    files.delete(stage)
    return manifest


def review(quarantined_rows, metadata_conflicts):
    """Whether someone must look at an export: of numbers, or of columns."""
    return (quarantined_rows > 0) | (metadata_conflicts > 0)


def rollup(days: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """One row: days wanted and seen, sums of the counts, and whether the range is complete."""
    wanted = times.dates_between(start, end)
    inside = (F.col("date") >= F.lit(wanted[0])) & (F.col("date") <= F.lit(wanted[-1]))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    counts = ("parsed_rows", "output_rows", "quarantined_rows", "upper_boundary_rows", "filtered_selection_rows", "filtered_instrument_rows")
    found = days.agg(F.count_distinct(F.when(inside & (F.col("output_rows") + F.col("quarantined_rows") > 0), F.col("date"))).alias("completed_days"), *map(total, counts))
    return found.withColumns({"requested_days": F.lit(len(wanted)).cast("long"), "status": F.when(F.col("completed_days") == len(wanted), "complete").otherwise("incomplete")})


def write_catalogs(spark: SparkSession, root: str) -> int:
    """The catalogs again, from the audit table and all runs' series; how many variables are described in several ways."""
    known = partitions(spark, root)
    if known is None:
        return 0
    for name, (make, order) in CATALOGS.items():
        store.write_csv(make(known), f"{root}/catalogs/{name}", *order)
    keys = ("measurement", "sensor", "vsn", "instrument_id", "identity_source")
    runs = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/_series")
    merged = catalog.merge_series(runs, *keys)
    text = merged.select(F.hex("series_id").alias("series_id"), *keys, F.array_join("fields", ";").alias("fields"), F.array_join("value_types", ";").alias("value_types"), times.rfc3339(F.col("minimum_time")).alias("minimum_time"), times.rfc3339(F.col("maximum_time")).alias("maximum_time"))
    store.write_csv(text, f"{root}/catalogs/series", "sensor", "vsn", "instrument_id", "measurement", "series_id")
    described = runs.select("sensor", "measurement", "fields", *[F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit("")).alias(k) for k in ("description", "units", "missing")], F.array_join("value_types", ";").alias("value_types"))
    conflicts = catalog.metadata_conflicts(described, ["description", "units", "missing", "value_types"])
    n = conflicts.count()
    store.write_csv(conflicts.withColumn("signatures", F.array_join("signatures", ";")), f"{root}/catalogs/metadata_conflicts", "sensor", "measurement", "field")
    return n


def day_range(first: str, last: str | None = None) -> tuple[datetime, datetime]:
    """Midnight of the first day, and after the last."""
    a = datetime.fromisoformat(first).replace(tzinfo=UTC)
    b = datetime.fromisoformat(last or first).replace(tzinfo=UTC)
    return a, datetime.fromtimestamp(b.timestamp() + 86_400, UTC)
