"""What happens to each point: kept, quarantined, or counted and left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.functions import times
from tsforge.functions.identity import Registry, instrument, retained, with_series_id
from tsforge.operators import many_selectors
from tsforge.operators import registry as rules
from tsforge.operators.selection import Selection
from tsforge.operators.store import sent_if_small

OUTPUT, UPPER, UNSELECTED, UNLISTED = "output", "upper_boundary", "filtered_selection", "filtered_instrument"
NO_VSN, NO_SENSOR = "missing-vsn", "missing-sensor"
DISPOSITIONS = (OUTPUT, "quarantined", UPPER, UNSELECTED, UNLISTED)


def disposition(start_ns: int | None, end_ns: int | None, matches: Column | None = None, candidate: Column | None = None, allowed: Column | None = None) -> Column:
    """The fate of rows with time_ns, vsn and sensor; the order of the rules decides.

    A row before the start is an error. What lacks an identity is quarantined if
    its measurement and field are wanted, whatever its tags, and is never asked
    for in the list of instruments.
    """
    t, vsn, sensor = F.col("time_ns"), F.col("vsn"), F.col("sensor")
    nameless = vsn.isNull() | sensor.isNull()
    fate = F.when(vsn.isNull(), NO_VSN).when(sensor.isNull(), NO_SENSOR).otherwise(OUTPUT)
    if allowed is not None:
        fate = F.when(~nameless & ~allowed, UNLISTED).otherwise(fate)
    if matches is not None:
        meant = nameless & candidate if candidate is not None else F.lit(False)
        fate = F.when(~matches & ~meant, UNSELECTED).otherwise(fate)
    if end_ns is not None:
        fate = F.when(t >= end_ns, UPPER).otherwise(fate)
    if start_ns is not None:
        fate = F.when(t < start_ns, F.raise_error(F.lit("a point precedes the range")).cast("string")).otherwise(fate)
    return fate


def is_quarantined(fate: Column) -> Column:
    return fate.isin(NO_VSN, NO_SENSOR)


def identified(points: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Points with series_id, vsn, sensor and instrument, worked out once for each distinct series.

    Points of line protocol bring them from the parser (``decode_identified``), which
    spares the join; then only the tag that is no part of an identity goes.
    """
    if "series_id" in points.columns:
        return points.withColumn("tags", retained(F.col("tags")))
    none_if_empty = lambda k: F.nullif(F.try_element_at(F.col("tags"), F.lit(k)), F.lit(""))
    key = F.to_json(F.array_sort(F.map_entries("tags")))
    keyed = points.withColumn("_series", F.concat_ws("\x1f", "measurement", key))
    series = rules.with_listed(keyed.groupBy("_series").agg(F.first("measurement").alias("measurement"), F.first("tags").alias("tags")), registry, ["_series"])
    named = with_series_id(series.withColumns({"vsn": none_if_empty("vsn"), "sensor": none_if_empty("sensor"), "instrument": instrument(F.col("measurement"), F.col("tags"), registry, F.col("_listed"))}).drop("_listed"))
    facts = named.select("_series", "series_id", "vsn", "sensor", F.col("instrument.instrument_id").alias("instrument_id"), F.col("instrument.source").alias("identity_source"))
    return keyed.withColumn("tags", retained(F.col("tags"))).join(facts, "_series").drop("_series")


def classify(points: DataFrame, start_ns: int | None = None, end_ns: int | None = None, selection: Selection | None = None, allowed_ids: set[str] | DataFrame | None = None) -> DataFrame:
    """Identified points with their ``disposition``; the list of instruments may be a table (instrument_id) of any length.

    A selection of many selectors is answered for distinct series, and its answers join the points; such tables are
    broadcast up to a checked size.
    """
    columns = points.columns
    m, f, tags = F.col("measurement"), F.col("field"), F.col("tags")
    wanted = (selection.matches(m, f, tags), selection.candidates(m, f)) if selection and len(selection.selectors) <= many_selectors.INLINE else (None, None)
    if selection and wanted[0] is None:
        points, wanted = many_selectors.answered(points, selection), (F.col("_takes"), F.col("_candidate"))
    if isinstance(allowed_ids, DataFrame):
        listed = allowed_ids.select("instrument_id").distinct().withColumn("_listed", F.lit(True))
        points = points.join(sent_if_small(listed), "instrument_id", "left")
        allowed = F.col("_listed").isNotNull()
    else:
        allowed = F.col("instrument_id").isin(sorted(allowed_ids)) if allowed_ids is not None else None
    return points.withColumn("disposition", disposition(start_ns, end_ns, *wanted, allowed)).select(*columns, "disposition")


def facts_of(classified: DataFrame) -> DataFrame:
    values = [c for c in classified.columns if c.startswith("value_")]
    return classified.filter(F.col("disposition") == OUTPUT).select("time_ns", times.micros(F.col("time_ns")).alias("time"), "sensor", "vsn", "instrument_id", "measurement", "field", "series_id", *values)


def quarantine_of(classified: DataFrame) -> DataFrame:
    values = [c for c in classified.columns if c.startswith("value_")]
    return classified.filter(is_quarantined(F.col("disposition"))).select(F.col("disposition").alias("reason"), times.date_of(F.col("time_ns")).alias("date"), "time_ns", "measurement", "field", "series_id", *values, "tags")


def summary(classified: DataFrame, by_day: bool = True, *by: str) -> DataFrame:
    """Counts of each fate, for each day (and what else is asked for); they add up to the parsed rows."""
    fate = F.col("disposition")
    keys = [times.date_of(F.col("time_ns")).alias("date"), *by] if by_day else [*by]
    count = lambda c: F.sum(c.cast("long"))
    return classified.groupBy(*keys).agg(
        F.count("*").alias("parsed_rows"), count(fate == OUTPUT).alias("output_rows"), count(is_quarantined(fate)).alias("quarantined_rows"),
        count(fate == UPPER).alias("upper_boundary_rows"), count(fate == UNSELECTED).alias("filtered_selection_rows"), count(fate == UNLISTED).alias("filtered_instrument_rows"),
    )


def kept_counts(classified: DataFrame, column: str, by_day: bool = True) -> DataFrame:
    """Kept rows for each measurement or value type, for each day."""
    keys = [times.date_of(F.col("time_ns")).alias("date")] if by_day else []
    return classified.filter(F.col("disposition") == OUTPUT).groupBy(*keys, column).agg(F.count("*").alias("rows"))
