"""Inventories of index entries: (measurement, field, tags, minimum_time, maximum_time, source, ordinal)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.functions.identity import Registry, instrument
from tsforge.operators import catalog
from tsforge.operators import registry as rules
from tsforge.operators.store import Files
from tsforge.sources import tables


def load(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Entries of the dumps at a path, and their sources with status, rows and first bad line.

    A source with a bad line gives no entries at all, and stops no other source.
    """
    lines = spark.read.text(path).withColumn("source", F.col("_metadata.file_path"))
    rows = tables.index_rows(lines, "value", "source")
    bad = F.when(~F.col("fits"), F.col("_line"))
    sources = rows.groupBy("source").agg(F.count("*").alias("rows"), F.min(bad).alias("error")).withColumn("status", F.when(F.col("error").isNull(), "complete").otherwise("error"))
    good = rows.join(sources.filter("error is null").select("source"), "source", "left_semi")
    return tables.with_tags(good).select("measurement", "tags", "field", "minimum_time", "maximum_time", "source"), sources


_SOURCES = "source string, size long, modified timestamp, rows long, error string, status string, source_id string"
_ENTRIES = "measurement string, tags map<string,string>, field string, minimum_time long, maximum_time long, source string, source_id string"


def update(spark: SparkSession, path: str, root: str) -> DataFrame:
    """Brings an inventory up to date with the dumps at a path, and returns its sources.

    A dump that is there unchanged and complete is not read again. A changed one
    replaces what it gave; one with a bad line takes back what it gave and is an
    error row. Entries are written before the sources that vouch for them, each
    source in a partition of its own, so an update that is cut short is made good
    by the next.
    """
    there = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"))
    known = sources(spark, root).filter("status = 'complete'").select("source", "size", "modified")
    new = there.join(known, ["source", "size", "modified"], "left_anti")
    fresh = [r.source for r in new.select("source").collect()]
    if fresh:
        entries, found = load(spark, fresh)
        name = F.sha1("source").alias("source_id")
        said = found.join(there, "source").select("source", "size", "modified", "rows", "error", "status", name)
        for rows, schema, part in ((entries.select("*", name), _ENTRIES, "entries"), (said, _SOURCES, "sources")):
            rows = rows.select(*(F.col(f.name) for f in spark.createDataFrame([], schema).schema))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").parquet(f"{root}/{part}")
    return sources(spark, root)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if Files(spark).exists(path) else spark.createDataFrame([], schema)


def sources(spark: SparkSession, root: str) -> DataFrame:
    """The sources of an inventory, with their status."""
    return _stored(spark, f"{root}/sources", _SOURCES)


def entries(spark: SparkSession, root: str) -> DataFrame:
    """The entries of an inventory's complete sources."""
    complete = sources(spark, root).filter("status = 'complete'").select("source_id")
    return _stored(spark, f"{root}/entries", _ENTRIES).join(complete, "source_id", "left_semi").drop("source_id")


def resolve(series: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Rolled-up series (with ``tags`` as a map) with the identity of their instrument and what their tags say."""
    tag = lambda k: F.nullif(F.try_element_at("tags", F.lit(k)), F.lit(""))
    listed = rules.with_listed(series.withColumn("_tags", F.to_json(F.array_sort(F.map_entries("tags")))), registry, ["measurement", "field", "_tags"])
    named = listed.withColumn("i", instrument(F.col("measurement"), F.col("tags"), registry, F.col("_listed"))).drop("_tags", "_listed")
    return named.select("*", tag("sensor").alias("sensor"), tag("units").alias("units"), tag("missing").alias("missing"), *[F.col(f"i.{c}").alias(c) for c in ("instrument_id", "source", "confidence", "review_required", "vsn", "kind", "zone")]).drop("i")


def rollup(entries: DataFrame, *series_keys: str) -> DataFrame:
    """One row for each series: times, blocks, and the first and last source by ordinal."""
    keys = list(series_keys) or ["measurement", "field", "tags"]
    return entries.groupBy(*keys).agg(F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"), F.count("*").alias("blocks"), F.min_by("source", "ordinal").alias("first_source"), F.max_by("source", "ordinal").alias("last_source"))


def instruments(resolved: DataFrame, *keys: str) -> DataFrame:
    found = resolved.groupBy(*keys).agg(F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"), F.count("*").alias("series"))
    return catalog.with_counts(found, resolved, list(keys), {"variables": F.struct("measurement", "field")})


def instrument_variables(resolved: DataFrame, *keys: str) -> DataFrame:
    """Each instrument's variables with the units and missing markers they were seen with."""
    seen = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",").alias(c)
    return resolved.groupBy(*keys, "measurement", "field").agg(seen("units"), seen("missing"), F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"), F.sum("blocks").alias("blocks"))


def measurements(resolved: DataFrame) -> DataFrame:
    found = resolved.groupBy("measurement", "field").agg(F.count("*").alias("series"), F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"))
    return catalog.with_counts(found, resolved, ["measurement", "field"], {"instruments": F.col("instrument_id")})


def family(resolved: DataFrame, prefix: str, sensor: str, column: str) -> DataFrame:
    """Distinct values of rows of a family: a measurement prefix, in any case, or a sensor."""
    mine = F.col("measurement").ilike(f"{prefix}%") | (F.lower(F.coalesce("sensor", F.lit(""))) == sensor)
    return resolved.filter(mine).select(column).distinct()


def status_counts(shards: DataFrame) -> DataFrame:
    return shards.groupBy("status").agg(F.count("*").alias("n"))


def pending(work: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Work whose key and identity have no marker."""
    return work.join(done, list(keys), "left_anti")
