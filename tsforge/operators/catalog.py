"""Catalogs: aggregations of facts, of partition statistics and of series."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.functions import times


def _span(*more: Column) -> list[Column]:
    return [*more, F.min("time_ns").alias("minimum_time"), F.max("time_ns").alias("maximum_time")]


def _counted(column: str) -> Column:
    """Rows by the values of a part of ``variables``, as a map in the order of its keys."""
    rows = lambda k: F.aggregate(F.filter("variables", lambda v: v[column] == k), F.lit(0).cast("long"), lambda n, v: n + v["rows"])
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.col(f"variables.{column}"))), lambda k: F.struct(k, rows(k))))


def partition_manifests(stats: DataFrame) -> DataFrame:
    """What is in each (sensor, vsn, instrument_id, date): rows and times, and rows by measurement, field, value type and variable.

    A partition's variables are some dozens, so they meet as one array; no fact is counted twice.
    """
    said = F.array_sort(F.collect_list(F.struct("measurement", "field", "value_type", "rows"))).alias("variables")
    found = stats.groupBy("sensor", "vsn", "instrument_id", "date").agg(F.sum("rows").alias("row_count"), F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"), said)
    return found.withColumns({"measurements": _counted("measurement"), "fields": _counted("field"), "value_types": _counted("value_type")})


def partition_stats(facts: DataFrame) -> DataFrame:
    """Rows and times of each (sensor, vsn, instrument_id, date), and how many measurements, fields and value types there are."""
    found = partition_manifests(partition_variables(facts)).drop("variables")
    return found.withColumns({c: F.size(c).cast("long") for c in ("measurements", "fields", "value_types")})


def partition_variables(facts: DataFrame) -> DataFrame:
    """Rows and times of each variable in each partition; all catalogs roll this up."""
    return facts.groupBy("sensor", "vsn", "instrument_id", times.date_of(F.col("time_ns")).alias("date"), "measurement", "field", "value_type").agg(*_span(F.count("*").alias("rows")))


def _rolled(stats: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return stats.groupBy(*keys).agg(*more, F.sum("rows").alias("rows"), F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"))


def sensors(stats: DataFrame) -> DataFrame:
    return with_counts(_rolled(stats, ["sensor"]), stats, ["sensor"], {"vsns": F.col("vsn"), "instruments": F.col("instrument_id")})


def instruments(stats: DataFrame) -> DataFrame:
    return _rolled(stats, ["sensor", "vsn", "instrument_id"])


def variables(stats: DataFrame) -> DataFrame:
    named = F.concat_ws("::", "sensor", "measurement", "field").alias("variable_id")
    return stats.groupBy("sensor", "measurement", "field").agg(F.sum("rows").alias("rows")).select(named, "sensor", "measurement", "field", "rows")


def instrument_variables(stats: DataFrame) -> DataFrame:
    named = F.concat_ws("::", "instrument_id", "measurement", "field").alias("variable_id")
    keys = ["sensor", "vsn", "instrument_id", "measurement", "field"]
    return stats.groupBy(*keys).agg(F.sum("rows").alias("rows")).select(named, *keys, "rows")


def _same(identity: tuple[str, ...], message: str, found: DataFrame) -> DataFrame:
    """A group's identity, or an error where the least and the greatest of a column (``_low_``, ``_high_``) differ."""
    for c in identity:
        clash = F.raise_error(F.lit(message)).cast(found.schema[f"_low_{c}"].dataType)
        found = found.withColumn(c, F.when(F.col(f"_low_{c}") != F.col(f"_high_{c}"), clash).otherwise(F.col(f"_low_{c}")))
    return found.drop(*(f"_{k}_{c}" for k in ("low", "high") for c in identity))


def _ends(identity: tuple[str, ...]) -> list[Column]:
    return [end(c).alias(f"_{k}_{c}") for c in identity for k, end in (("low", F.min), ("high", F.max))]


def series(facts: DataFrame, *identity: str) -> DataFrame:
    """Times, fields and value types of each series; differing identities of one id are an error."""
    sets = [F.sort_array(F.collect_set(c)).alias(n) for c, n in (("field", "fields"), ("value_type", "value_types"))]
    return _same(identity, "two series share an id", facts.groupBy("series_id").agg(*_span(), *sets, *_ends(identity)))


def merge_series(runs: DataFrame, *identity: str) -> DataFrame:
    """The series of several runs: wider times, united fields and types, the same identity or an error."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    found = runs.groupBy("series_id").agg(F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"), union("fields"), union("value_types"), *_ends(identity))
    return _same(identity, "runs disagree about a series", found)


def metadata_conflicts(series_df: DataFrame, signature: list[str]) -> DataFrame:
    """Variables that series describe in more than one way: sensor, measurement, field, signatures (JSON, sorted)."""
    said = F.to_json(F.struct(*signature), {"ignoreNullFields": "false"})
    found = series_df.select("sensor", "measurement", F.explode("fields").alias("field"), said.alias("said")).groupBy("sensor", "measurement", "field").agg(F.sort_array(F.collect_set("said")).alias("signatures"))
    return found.filter(F.size("signatures") > 1)


def with_series(facts: DataFrame, series_df: DataFrame) -> DataFrame:
    """Facts with the tags of their series."""
    return facts.join(series_df.select("series_id", "tags"), "series_id")


def distinct_counts(rows: DataFrame, by: list[str], counted: dict[str, Column]) -> DataFrame:
    """Exact numbers of distinct values (nulls left out) of several columns for each group, in two bounded exchanges.

    A value is owned by the task that its group and itself hash to, which counts it
    once; owners' counts are summed. So a group that holds all rows is dealt over all
    tasks, and no row is multiplied before the first combination but by its columns.
    """
    names = list(counted)
    values = F.array(*[F.struct(F.lit(i).alias("of"), F.to_json(F.struct(c.alias("v"))).alias("value"), c.isNotNull().alias("known")) for i, c in enumerate(counted.values())])
    each = rows.select(*by, F.explode(values).alias("x")).select(*by, "x.of", F.when(F.col("x.known"), F.col("x.value")).alias("value"))
    owned = each.groupBy(*by, "of", "value").agg(F.lit(1).alias("one"))
    return owned.groupBy(*by).agg(*[F.count_if((F.col("of") == i) & F.col("value").isNotNull()).alias(name) for i, name in enumerate(names)])


def with_counts(found: DataFrame, rows: DataFrame, by: list[str], counted: dict[str, Column]) -> DataFrame:
    """Groups with the distinct counts of the rows that they were made of; null keys are groups."""
    counts = distinct_counts(rows, by, counted).withColumnsRenamed({c: f"_{c}" for c in by})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return found.join(counts, same).drop(*(f"_{c}" for c in by))
