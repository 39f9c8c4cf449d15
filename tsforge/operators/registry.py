"""Registries of any number of rules, looked up by joins.

A rule agrees with a series if all its tags do, and the first rule wins. Rules
are grouped by the set of their tag names (their shape; there are few). A series
asks once for each shape that its tags cover, with the values of those tags as a
key, and one join answers all: the work of a series grows with the shapes, not
with the rules, and the plan with neither. Rules are broadcast up to a checked
size and shuffled beyond it; the distinct series are grouped before, so answers
meet their series where these are already.

Defined results: a rule without tags agrees with nothing; rules that say the same
are one, the first; a null id or tag value agrees with nothing. No rules give nulls.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.functions.identity import DROPPED_TAG, Registry
from tsforge.operators.store import kept, sent_if_small

#: Rules up to which they are one expression.
INLINE = 64


def rules_of(spark: SparkSession, registry: Registry) -> DataFrame:
    """A registry as a table: number, instrument_id, match."""
    rows = [(i, r.instrument_id, json.dumps(dict(r.match))) for i, r in enumerate(registry.rules)]
    return spark.createDataFrame(rows, "number long, instrument_id string, match string").withColumn("match", F.from_json("match", "map<string,string>"))


def _key(shape: Column, values: Column) -> Column:
    return F.to_json(F.struct(shape.alias("k"), values.alias("v")))


def indexed(rules: DataFrame) -> DataFrame:
    """The first rule of each shape and values: key, shape, number, instrument_id."""
    shape = F.array_sort(F.map_keys("match"))
    known = rules.filter(F.size("match") > 0).select("number", "instrument_id", shape.alias("shape"), F.transform(shape, lambda k: F.element_at("match", k)).alias("values"))
    known = known.filter(~F.exists("values", lambda v: v.isNull()) & F.col("instrument_id").isNotNull())
    return known.groupBy(_key(F.col("shape"), F.col("values")).alias("key")).agg(F.min(F.struct("number", "instrument_id")).alias("rule"), F.first("shape").alias("shape")).select("key", "shape", "rule.*")


def listed(series: DataFrame, rules: DataFrame, by: list[str], name: str = "listed") -> DataFrame:
    """Series (distinct by ``by``, with ``tags``) with the id that the rules (number, instrument_id, match) give, or null."""
    known = kept(indexed(rules), "rules")
    shapes = [r.shape for r in known.select("shape").distinct().collect()]  # few: sets of tag names
    if not shapes:
        return series.withColumn(name, F.lit(None).cast("string"))
    tags = F.map_filter("tags", lambda k, _: k != DROPPED_TAG)
    every = F.from_json(F.lit(json.dumps(shapes)), "array<array<string>>")
    asked = F.transform(every, lambda s: F.when(F.size(F.array_intersect(s, F.map_keys(tags))) == F.size(s), _key(s, F.transform(s, lambda k: F.element_at(tags, k)))))
    rest = [c for c in series.columns if c not in by]
    asking = series.select(*by, F.struct(*rest).alias("_rest"), F.explode_outer(F.array_compact(asked)).alias("key"))
    met = asking.join(sent_if_small(known.select("key", "number", "instrument_id")), "key", "left")
    found = met.groupBy(*by).agg(F.min(F.when(F.col("number").isNotNull(), F.struct("number", "instrument_id"))).alias("_rule"), F.first("_rest").alias("_rest"))
    return found.select(*(F.col(c) if c in by else F.col(f"_rest.{c}").alias(c) for c in series.columns), F.col("_rule.instrument_id").alias(name))


def with_listed(series: DataFrame, registry: Registry | None, by: list[str], name: str = "_listed") -> DataFrame:
    """As ``listed``, of a registry: one expression while it has few rules."""
    if registry is None or len(registry.rules) <= INLINE:
        return series.withColumn(name, (registry or Registry()).lookup(F.col("tags")))
    return listed(series, rules_of(series.sparkSession, registry), by, name)
