"""The registered queries of the engine, and the SQL that says the same.

Facts are derived from the ``events`` table (one value each, with markers, NaN,
nulls and missing identities at fixed ids) and from ``lineitem`` (five typed
fields). Each query is an operator of the engine over those facts.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge import schema
from tsforge.functions import identity, times
from tsforge.functions.globs import matches
from tsforge.operators import buckets, catalog, commits, file_index, ingest, inventory, kept_series, many_selectors, ranges, registry, store
from tsforge.operators.selection import Selection
from tsforge.plans import backup, export, level1, qc, runner
from tsforge.plans.qc_config import Rules, Run
from tsforge.sources import cdf, line_protocol, tables, tsm

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- derived facts

START_NS = times.to_ns(datetime(2024, 1, 1, tzinfo=UTC))
END_NS = times.to_ns(datetime(2024, 1, 21, tzinfo=UTC))

_EV = """ev0 AS (
    SELECT event_id, user_id, props, event_type, epoch_us(ts) * 1000 + event_id % 1000 AS time_ns, 'evt.' || event_type AS measurement, 'value' AS field, 'float64' AS value_type,
           CASE WHEN event_id % 83 = 0 THEN NULL ELSE event_type END AS sensor, CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'W' || lpad((user_id % 64)::VARCHAR, 3, '0') END AS vsn,
           CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'core' ELSE 'shield roof' END AS zone,
           CASE WHEN event_id % 97 = 0 THEN -9999.9 WHEN event_id % 101 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 103 = 0 THEN NULL ELSE value END AS value
    FROM events),
ev1 AS (SELECT *, '{"measurement":"' || measurement || '","tags":{' || concat_ws(',', '"sensor":"' || sensor || '"', '"vsn":"' || vsn || '"', '"zone":"' || zone || '"') || '}}' AS series_json,
        coalesce(vsn, 'unknown-vsn') AS known_vsn, coalesce(sensor, 'evt') AS kind, coalesce(zone, 'unknown-zone') AS known_zone FROM ev0),
ev AS (SELECT *, substr(sha256(series_json), 1, 32) AS series_id,
        known_vsn || '--' || lower(kind) || '--' || lower(replace(known_zone, ' ', '-')) || '--' || substr(sha256('{"device": "unknown-device", "kind": "' || kind || '", "vsn": "' || known_vsn || '", "zone": "' || known_zone || '"}'), 1, 12) AS instrument_id,
        'vsn+' || CASE WHEN sensor IS NULL THEN 'measurement' ELSE 'sensor' END AS identity_source,
        CASE WHEN sensor IS NULL OR vsn IS NULL THEN 'low' ELSE 'high' END AS confidence,
        strftime(make_timestamp(time_ns // 1000), '%Y-%m-%d') AS day FROM ev1)"""


def sql(body: str, *more: str) -> str:
    return f"WITH {', '.join([_EV, *more])} {body}"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of ``events`` before their series are named: with tags, value and user columns."""
    e = _read(spark, sf_dir, "events")
    # events.ts has no time zone; the difference does not depend on the session's
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    n = F.col("event_id")
    value = F.when(n % 97 == 0, -9999.9).when(n % 101 == 0, float("nan")).when(n % 103 == 0, None).otherwise(F.col("value"))
    sensor = F.when(n % 83 != 0, F.col("event_type"))
    vsn = F.when(n % 89 != 0, F.concat(F.lit("W"), F.lpad((F.col("user_id") % 64).cast("string"), 3, "0")))
    zone = F.when(F.col("user_id") % 3 == 0, None).when(F.col("user_id") % 2 == 0, "core").otherwise("shield roof")
    tags = F.map_filter(F.create_map(F.lit("node"), F.concat(F.lit("n"), F.col("user_id").cast("string")), F.lit("sensor"), sensor, F.lit("vsn"), vsn, F.lit("zone"), zone), lambda _, v: v.isNotNull())
    return e.select("event_id", "user_id", "props", "event_type", (micros * 1000 + n % 1000).alias("time_ns"), F.concat(F.lit("evt."), F.col("event_type")).alias("measurement"), F.lit("value").alias("field"), F.lit("float64").alias("value_type"), sensor.alias("sensor"), vsn.alias("vsn"), zone.alias("zone"), tags.alias("tags"), value.alias("value"))


SERIES = ("measurement", "sensor", "vsn", "zone")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their series' and instruments' identities, worked out once for each series (JVM-side: these tags are ASCII)."""
    rows = events(spark, sf_dir)
    m, tags = F.col("measurement"), F.map_filter(F.create_map(*(x for k in SERIES[1:] for x in (F.lit(k), F.col(k)))), lambda _, v: v.isNotNull())
    series = rows.select(*SERIES).distinct()
    named = series.select(*(F.col(k).alias(f"_{k}") for k in SERIES), identity.series_id(m, tags).alias("series_id"), identity.instrument(m, tags).alias("instrument"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in SERIES])
    joined = rows.join(named, same).drop(*(f"_{k}" for k in SERIES))
    return joined.withColumns({"instrument_id": F.col("instrument.instrument_id"), "identity_source": F.col("instrument.source"), "confidence": F.col("instrument.confidence"), "day": F.date_format(times.date_of(F.col("time_ns")), "yyyy-MM-dd")})


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of line protocol made of ``events``, with escapes and quoted newlines."""
    esc = lambda c: F.regexp_replace(c, r"([,= ])", r"\\$1")
    e = events(spark, sf_dir).filter("value is not null and not isnan(value)")
    tag = lambda k: F.when(F.col(k).isNotNull(), F.concat(F.lit(f",{k}="), esc(F.col(k)))).otherwise("")
    text = F.concat(F.lit('"'), F.regexp_replace(F.concat(F.col("props"), F.lit("\nend")), r'(["\\])', r"\\$1"), F.lit('"'))
    fields = F.concat(F.lit("value="), F.col("value").cast("string"), F.lit(",event\\ id="), F.col("event_id").cast("string"), F.lit("i,user="), F.col("user_id").cast("string"), F.lit("u,even="), F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"), F.lit(",props="), text)
    return e.select(F.concat(F.col("measurement"), F.lit(",node=n1"), tag("sensor"), tag("vsn"), tag("zone"), F.lit(" "), fields, F.lit(" "), F.col("time_ns").cast("string")).alias("record"))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five typed fields of each line item, unpivoted in one pass."""
    li = _read(spark, sf_dir, "lineitem")
    row = lambda name, kind, value: F.struct(F.lit(name).alias("field"), F.lit(kind).alias("value_type"), *[(value.cast(t) if k == kind else F.lit(None).cast(t)).alias(f"value_{k}") for k, t in schema.VALUE_COLUMNS.items()])
    rows = F.array(row("quantity", "int64", F.col("l_quantity")), row("extendedprice", "float64", F.col("l_extendedprice")), row("orderkey", "uint64", F.col("l_orderkey")), row("open", "bool", F.col("l_linestatus") == "O"), row("returnflag", "string", F.col("l_returnflag")))
    return li.select("l_orderkey", F.inline(rows))


# ---------------------------------------------------------------- quality rules

RULES = Rules.from_document(
    {
        "schema_version": 1,
        "flags": {"missing_value": {"bit": 0}, "missing_sample": {"bit": 1}, "physical_range": {"bit": 2}, "instrument_range": {"bit": 3}, "top": {"bit": 63}},
        "profiles": {
            "events": {
                "variables": {
                    kind: {
                        "column": "value",
                        "where": {"measurement": f"evt.{kind}", "field": "value"},
                        "missing_values": [-9999.9],
                        "checks": [
                            {"id": f"{kind}_missing", "method": "col_vals_not_null", "flag": "missing_value"},
                            {"id": f"{kind}_physical", "method": "col_vals_between", "flag": "physical_range", "args": {"left": 0.5, "right": 200}},
                            {"id": f"{kind}_instrument", "method": "col_vals_between", "flag": "instrument_range", "args": {"left": 1, "right": 100, "inclusive": [False, True]}, "thresholds": {"warning": 0.01, "error": 0.5}},
                            {"id": f"{kind}_top", "method": "col_vals_between", "flag": "top", "args": {"left": 0, "right": 50}},
                        ],
                    }
                    for kind in ("click", "error", "view", "absent")
                }
            }
        },
    }
)
PROFILE = RULES.profiles["events"]
KEYS = ("time_ns", "series_id")

_OBS = """obs AS (SELECT time_ns, series_id, sensor, vsn, event_id, day, event_type AS variable, CASE WHEN isnan(value) OR value = -9999.9 THEN NULL ELSE value END AS v
    FROM ev WHERE event_type IN ('click', 'error', 'view'))"""
_CHECKS = """checks(variable, suffix, flag_name, bit) AS (SELECT v, s, f, b FROM (VALUES ('click'), ('error'), ('view'), ('absent')) AS x(v),
    (VALUES ('_missing', 'missing_value', 0), ('_physical', 'physical_range', 2), ('_instrument', 'instrument_range', 3), ('_top', 'top', 63)) AS y(s, f, b))"""
_FAILED = "CASE bit WHEN 0 THEN v IS NULL WHEN 2 THEN coalesce(NOT (v >= 0.5 AND v <= 200), false) WHEN 3 THEN coalesce(NOT (v > 1 AND v <= 100), false) ELSE coalesce(NOT (v >= 0 AND v <= 50), false) END"
_FIND = f"find AS (SELECT obs.*, variable || suffix AS check_id, flag_name, bit FROM obs JOIN checks USING (variable) WHERE {_FAILED})"
_MASKS = "masks AS (SELECT time_ns, series_id, variable, bit_or(1::UBIGINT << bit) AS bits FROM find GROUP BY ALL)"


def observations(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return qc.normalize(qc.select(facts(spark, sf_dir), PROFILE), PROFILE, KEYS, "sensor", "vsn", "event_id", "day", *more)


def _flagged(spark, sf_dir):
    return qc.flagged(observations(spark, sf_dir), PROFILE, RULES, KEYS)


@query(sql("SELECT sensor, vsn, coalesce(bits, 0)::VARCHAR AS qc_bits, count(*) AS n, min(time_ns) AS first_ns FROM obs LEFT JOIN masks USING (time_ns, series_id, variable) GROUP BY ALL", _OBS, _CHECKS, _FIND, _MASKS))
def qc_histogram(spark, sf_dir):
    """Masks attached to observations and counted: the whole of quality control."""
    return _flagged(spark, sf_dir).groupBy("sensor", "vsn", F.col("qc_bits").cast("string").alias("qc_bits")).agg(F.count("*").alias("n"), F.min("time_ns").alias("first_ns"))


@query(sql("SELECT event_id, variable, v AS observed_value FROM obs", _OBS))
def normalize_observations(spark, sf_dir):
    return observations(spark, sf_dir).select("event_id", "variable", "observed_value")


@query("SELECT p_partkey, CASE WHEN p_brand IN ('Brand#11', 'Brand#22', '') THEN NULL ELSE p_brand END AS brand, CASE WHEN p_type IN ('STEEL') THEN NULL ELSE p_type END AS type FROM part")
def normalize_strings(spark, sf_dir):
    p = _read(spark, sf_dir, "part")
    return p.select("p_partkey", qc.text_or_null(F.col("p_brand"), ("Brand#11", "Brand#22", "")).alias("brand"), qc.text_or_null(F.col("p_type"), ("STEEL",)).alias("type"))


def _one_check(spark, sf_dir, suffix):
    found = qc.findings(observations(spark, sf_dir), PROFILE, RULES)
    return found.filter(F.col("check_id").endswith(suffix)).select("event_id", "check_id", "observed_value")


def _one_sql(bit):
    return sql(f"SELECT event_id, check_id, v AS observed_value FROM find WHERE bit = {bit}", _OBS, _CHECKS, _FIND)


@query(_one_sql(0))
def check_not_null(spark, sf_dir):
    return _one_check(spark, sf_dir, "_missing")


@query(_one_sql(2))
def check_between(spark, sf_dir):
    return _one_check(spark, sf_dir, "_physical")


@query(_one_sql(3))
def check_between_exclusive(spark, sf_dir):
    return _one_check(spark, sf_dir, "_instrument")


@query(sql("SELECT event_id, variable, check_id, bit, v AS observed_value, 'r1' AS run_id, 'u1' AS work_unit_id FROM find", _OBS, _CHECKS, _FIND))
def findings(spark, sf_dir):
    return qc.findings(observations(spark, sf_dir), PROFILE, RULES, "r1", "u1").select("event_id", "variable", "check_id", "bit", "observed_value", "run_id", "work_unit_id")


_RESULTS = f"""results AS (SELECT {{day}} variable || suffix AS check_id, variable, flag_name, bit, count(time_ns) AS units_tested, coalesce(sum(CASE WHEN time_ns IS NOT NULL AND {_FAILED} THEN 1 ELSE 0 END), 0)::BIGINT AS units_failed
    FROM {{left}} LEFT JOIN obs USING ({{using}}) GROUP BY ALL)"""
_LEVELS = "units_tested - units_failed AS units_passed, CASE WHEN units_tested > 0 THEN units_failed / units_tested ELSE 0.0 END AS fraction_failed, units_tested > 0 AND bit = 3 AND units_failed / units_tested >= 0.01 AS warning, units_tested > 0 AND bit = 3 AND units_failed / units_tested >= 0.5 AS error"


@query(sql(f"SELECT *, {_LEVELS} FROM results", _OBS, _CHECKS, _RESULTS.format(day="", left="checks", using="variable")))
def check_results(spark, sf_dir):
    found = qc.check_results(observations(spark, sf_dir), PROFILE, RULES)
    return found.select("check_id", "variable", "flag_name", "bit", "units_tested", "units_failed", "units_passed", "fraction_failed", "warning", "error")


_BY_DAY = _RESULTS.format(day="day,", left="(SELECT * FROM checks, (SELECT DISTINCT day FROM obs))", using="variable, day")


@query(sql("""SELECT variable, check_id, flag_name, bit, sum(units_tested)::BIGINT AS units_tested, sum(units_tested - units_failed)::BIGINT AS units_passed, sum(units_failed)::BIGINT AS units_failed,
    CASE WHEN sum(units_tested) > 0 THEN sum(units_failed) / sum(units_tested) ELSE 0.0 END AS fraction_failed FROM results GROUP BY variable, check_id, flag_name, bit""", _OBS, _CHECKS, _BY_DAY))  # fmt: skip
def run_report(spark, sf_dir):
    """Check results of each day, summed over the days."""
    return qc.report(qc.check_results(observations(spark, sf_dir), PROFILE, RULES, "day"))


@query(sql("SELECT (SELECT count(*) FROM obs) AS rows_processed, (SELECT count(*) FROM find) AS findings, (SELECT count(DISTINCT day) FROM obs) AS periods", _OBS, _CHECKS, _FIND))
def run_totals(spark, sf_dir):
    """The markers of all periods of a run (here days), summed."""
    seen = observations(spark, sf_dir).withColumn("_source_file", F.lit("events"))
    marked = runner.marks(seen, qc.findings(seen.drop("_source_file"), PROFILE, RULES), "day")
    return runner.tally(marked).select("rows_processed", "findings", F.col("complete").alias("periods"))


@query(sql("SELECT time_ns, series_id, variable, CASE WHEN bits >= 9223372036854775808 THEN (bits::HUGEINT - 18446744073709551616)::BIGINT ELSE bits::BIGINT END AS mask FROM masks", _OBS, _CHECKS, _FIND, _MASKS))
def qc_bits(spark, sf_dir):
    return qc.compile_masks(qc.findings(observations(spark, sf_dir), PROFILE, RULES), KEYS).select("time_ns", "series_id", "variable", "mask")


@query(sql("SELECT time_ns, series_id, variable, bits::VARCHAR AS qc_bits FROM masks", _OBS, _CHECKS, _FIND, _MASKS))
def qc_bits_u64(spark, sf_dir):
    return qc.compile_masks(qc.findings(observations(spark, sf_dir), PROFILE, RULES), KEYS).select("time_ns", "series_id", "variable", F.col("qc_bits").cast("string").alias("qc_bits"))


@query(sql("SELECT event_id, variable, v AS observed_value, coalesce(bits, 0)::VARCHAR AS qc_bits FROM obs LEFT JOIN masks USING (time_ns, series_id, variable)", _OBS, _CHECKS, _FIND, _MASKS))
def flag_attach(spark, sf_dir):
    """Compiled masks of stored findings, joined to the observations."""
    seen = observations(spark, sf_dir)
    joined = qc.attach_masks(seen, qc.compile_masks(qc.findings(seen, PROFILE, RULES), KEYS), KEYS)
    return joined.select("event_id", "variable", "observed_value", F.col("qc_bits").cast("string").alias("qc_bits"))


@query(sql("""SELECT variable, first_second, end_second, 'PT' || (end_second - first_second)::VARCHAR || 'S' AS duration FROM
    (SELECT variable, min(time_ns) // 1000000000 AS first_second, max(time_ns) // 1000000000 + 1 AS end_second FROM obs GROUP BY variable)""", _OBS))  # fmt: skip
def coverage_attributes(spark, sf_dir):
    return level1.coverage(observations(spark, sf_dir), "variable")


@query(sql("SELECT variable, CASE variable WHEN 'click' THEN 0 WHEN 'error' THEN 1 ELSE 2 END AS variable_code, count(*) AS n FROM obs GROUP BY ALL", _OBS))
def variable_codes(spark, sf_dir):
    return level1.with_codes(observations(spark, sf_dir), level1.variable_codes(PROFILE)).groupBy("variable", "variable_code").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- line protocol and typed values


@query(sql("""SELECT measurement, sensor, vsn, zone, time_ns, value, event_id AS "event id", user_id::VARCHAR AS "user", event_id % 2 = 0 AS even, props || chr(10) || 'end' AS props FROM ev WHERE value IS NOT NULL AND NOT isnan(value)"""))
def lp_roundtrip(spark, sf_dir):
    """Events written as line protocol and read again."""
    points = line_protocol.decode(line_protocol.spread(lines(spark, sf_dir), "record"))
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    one = lambda field, c, out: F.max(F.when(F.col("field") == field, F.col(c))).alias(out)
    rows = points.groupBy("measurement", tag("sensor").alias("sensor"), tag("vsn").alias("vsn"), tag("zone").alias("zone"), "time_ns")
    return rows.agg(one("value", "value_float64", "value"), one("event id", "value_int64", "event id"), one("user", "value_uint64", "u"), one("even", "value_bool", "even"), one("props", "value_string", "props")).withColumn("user", F.col("u").cast("string")).drop("u")


@query(sql("""SELECT f AS field, t AS value_type, count(*) AS n FROM ev, (VALUES ('value', 'float64'), ('event id', 'int64'), ('user', 'uint64'), ('even', 'bool'), ('props', 'string')) AS x(f, t)
    WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL"""))  # fmt: skip
def lp_field_types(spark, sf_dir):
    points = line_protocol.decode(line_protocol.spread(lines(spark, sf_dir), "record"))
    return points.filter(schema.filled() == 1).groupBy("field", "value_type").agg(F.count("*").alias("n"))


_LI = """li AS (SELECT 'quantity' AS field, 'int64' AS value_type, l_quantity::BIGINT::DOUBLE AS number, NULL AS string FROM lineitem UNION ALL SELECT 'extendedprice', 'float64', l_extendedprice, NULL FROM lineitem
    UNION ALL SELECT 'orderkey', 'uint64', l_orderkey::DOUBLE, NULL FROM lineitem UNION ALL SELECT 'open', 'bool', (l_linestatus = 'O')::INT::DOUBLE, NULL FROM lineitem UNION ALL SELECT 'returnflag', 'string', NULL, l_returnflag FROM lineitem)"""


@query(f"WITH {_LI} SELECT field, value_type, count(*) AS n, min(number) AS low, max(number) AS high, min(string) AS first, max(string) AS last FROM li GROUP BY ALL")
def lp_typed_fields(spark, sf_dir):
    rows = typed(spark, sf_dir)
    number = F.coalesce(F.col("value_float64"), F.col("value_int64").cast("double"), F.col("value_uint64").cast("double"), F.col("value_bool").cast("int").cast("double"))
    return rows.groupBy("field", "value_type").agg(F.count("*").alias("n"), F.min(number).alias("low"), F.max(number).alias("high"), F.min("value_string").alias("first"), F.max("value_string").alias("last"))


@query("SELECT count(*) * 5 AS n, 0::BIGINT AS broken, count(*) AS float64, count(*) AS int64, count(*) AS uint64, count(*) AS bool, count(*) AS string FROM lineitem")
def facts_unpivot(spark, sf_dir):
    """One value column is filled in every row."""
    return typed(spark, sf_dir).agg(F.count("*").alias("n"), F.sum((schema.filled() != 1).cast("long")).alias("broken"), *[F.count(f"value_{k}").alias(k) for k in schema.VALUE_TYPES])


@query("SELECT p_partkey, 'float64' AS value_type, try_cast(p_retailprice::VARCHAR AS DOUBLE) AS value_float64 FROM part")
def typed_parse(spark, sf_dir):
    p = _read(spark, sf_dir, "part").select("p_partkey", F.lit("float64").alias("value_type"), F.col("p_retailprice").cast("string").alias("text"))
    return p.select("p_partkey", "value_type", schema.typed_values("value_type", "text")[0])


# ---------------------------------------------------------------- identities and times


@query(sql("SELECT DISTINCT measurement, sensor, vsn, zone, series_id FROM ev"))
def series_id_hash(spark, sf_dir):
    return facts(spark, sf_dir).select("measurement", "sensor", "vsn", "zone", "series_id").distinct()


@query(sql("SELECT DISTINCT measurement, sensor, vsn, zone, instrument_id, identity_source, confidence, confidence <> 'high' AS review_required FROM ev"))
def instrument_identity(spark, sf_dir):
    return facts(spark, sf_dir).select("measurement", "sensor", "vsn", "zone", "instrument_id", "identity_source", "confidence", F.col("instrument.review_required").alias("review_required")).distinct()


_REGISTRY = identity.Registry.from_document({"rules": [{"instrument_id": "w001-click", "match": {"vsn": "W001", "sensor": "click"}}, {"instrument_id": "all-w001", "match": {"vsn": "W001"}}, {"instrument_id": "core-views", "match": {"sensor": "view", "zone": "core"}}]})
_LISTED = "CASE WHEN vsn = 'W001' AND sensor = 'click' THEN 'w001-click' WHEN vsn = 'W001' THEN 'all-w001' WHEN sensor = 'view' AND zone = 'core' THEN 'core-views' END"


@query(sql(f"SELECT DISTINCT sensor, vsn, zone, coalesce({_LISTED}, instrument_id) AS instrument_id, CASE WHEN {_LISTED} IS NULL THEN identity_source ELSE 'registry' END AS source, CASE WHEN {_LISTED} IS NULL THEN confidence ELSE 'high' END AS confidence FROM ev"))
def instrument_registry(spark, sf_dir):
    named = facts(spark, sf_dir).withColumn("i", identity.instrument(F.col("measurement"), F.col("tags"), _REGISTRY))
    return named.select("sensor", "vsn", "zone", "i.instrument_id", "i.source", "i.confidence").distinct()


@query("SELECT o_orderkey, strftime(DATE '1970-01-01' + floor((o_orderkey - 500) * 3600.0 * 7 / 86400)::INT, '%Y-%m-%d') AS day FROM orders")
def ns_day_partition(spark, sf_dir):
    """Days of times before and after 1970, be they beyond the years that 64-bit nanoseconds reach (1677 to 2262)."""
    t = (F.col("o_orderkey") - 500).cast("decimal(19,0)") * F.lit(7 * 3600 * times.SECOND).cast("decimal(14,0)")
    return _read(spark, sf_dir, "orders").select("o_orderkey", times.day_text(times.date_of(t)).alias("day"))


@query(sql("SELECT event_id, strftime(make_timestamp(time_ns // 1000), '%Y-%m-%dT%H:%M:%S') || '.' || lpad((time_ns % 1000000000)::VARCHAR, 9, '0') || 'Z' AS text, time_ns AS parsed FROM ev"))
def rfc3339_format(spark, sf_dir):
    text = times.rfc3339(F.col("time_ns"))
    return events(spark, sf_dir).select("event_id", text.alias("text"), times.parse_rfc3339(text).alias("parsed"))


# ---------------------------------------------------------------- ingest

_SELECTION = Selection.from_document({"selection_version": 2, "selectors": [{"measurement": "evt.click", "tags": {"vsn": ["W00*", "W03[0-4]"]}}, {"measurement_glob": "evt.?r*", "fields": ["val*"]}, {"measurement": "evt.view", "tags": {"zone": ["core"], "vsn": ["W*[!0-8]"]}}]})
_MATCH = "coalesce((measurement = 'evt.click' AND regexp_full_match(vsn, 'W00.*|W03[0-4]')) OR regexp_full_match(measurement, 'evt\\..r.*') OR (measurement = 'evt.view' AND zone = 'core' AND regexp_full_match(vsn, 'W.*[^0-8]')), false)"
_CANDIDATE = "(measurement IN ('evt.click', 'evt.view') OR regexp_full_match(measurement, 'evt\\..r.*'))"
_ALLOWED = "substr(sha256(instrument_id), 1, 1) < 'd'"
_FATE = f"""fate AS (SELECT *, CASE WHEN time_ns >= {END_NS} THEN 'upper_boundary' WHEN NOT {_MATCH} AND NOT ((vsn IS NULL OR sensor IS NULL) AND {_CANDIDATE}) THEN 'filtered_selection'
    WHEN vsn IS NOT NULL AND sensor IS NOT NULL AND NOT {_ALLOWED} THEN 'filtered_instrument' WHEN vsn IS NULL THEN 'missing-vsn' WHEN sensor IS NULL THEN 'missing-sensor' ELSE 'output' END AS disposition FROM ev)"""


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, f, tags = F.col("measurement"), F.col("field"), F.col("tags")
    allowed = F.substring(F.sha2("instrument_id", 256), 1, 1) < "d"
    fate = ingest.disposition(START_NS, END_NS, _SELECTION.matches(m, f, tags), _SELECTION.candidates(m, f), allowed)
    return facts(spark, sf_dir).withColumn("disposition", fate)


@query(sql(f"SELECT time_ns >= {END_NS} AS late, count(*) AS n, min(time_ns) AS low, max(time_ns) AS high FROM ev GROUP BY ALL"))
def range_boundary(spark, sf_dir):
    fate = ingest.disposition(START_NS, END_NS)
    return facts(spark, sf_dir).groupBy((fate == ingest.UPPER).alias("late")).agg(F.count("*").alias("n"), F.min("time_ns").alias("low"), F.max("time_ns").alias("high"))


@query(sql(f"SELECT event_id FROM ev WHERE {_MATCH}"))
def selection_match(spark, sf_dir):
    return events(spark, sf_dir).filter(_SELECTION.matches(F.col("measurement"), F.col("field"), F.col("tags"))).select("event_id")


@query(sql("SELECT event_id, event_type FROM ev WHERE regexp_full_match(event_type, '[ce].*k')"))
def glob_match(spark, sf_dir):
    return events(spark, sf_dir).filter(matches(F.col("event_type"), "[ce]*k")).select("event_id", "event_type")


@query(sql("""SELECT coalesce(sensor, '') AS sensor, coalesce(vsn, '') AS vsn, CASE WHEN vsn IS NULL THEN 'missing-vsn' WHEN sensor IS NULL THEN 'missing-sensor'
    WHEN vsn IN ('W001', 'W002', 'W063') AND sensor = 'click' THEN 'output' ELSE 'filtered_instrument' END AS fate, count(*) AS n FROM ev GROUP BY ALL"""))  # fmt: skip
def allowlist_filter(spark, sf_dir):
    """The fate of rows by a list of instruments, read from lines with comments; the list is a table, as long as it may be."""
    rows = facts(spark, sf_dir)
    ids = rows.filter("vsn in ('W001', 'W002', 'W063') and sensor = 'click'").select("instrument_id").distinct()
    text = ids.select(F.concat(F.lit("  "), "instrument_id", F.lit("  # listed")).alias("value")).unionByName(spark.createDataFrame([("# a comment",), ("",)], "value string"))
    fate = ingest.classify(rows, allowed_ids=tables.parse_list(text))
    return fate.groupBy(F.coalesce("sensor", F.lit("")).alias("sensor"), F.coalesce("vsn", F.lit("")).alias("vsn"), F.col("disposition").alias("fate")).agg(F.count("*").alias("n"))


@query(sql("SELECT disposition AS reason, day AS date, event_id, series_id FROM fate WHERE disposition LIKE 'missing-%'", _FATE))
def quarantine_split(spark, sf_dir):
    rows = classified(spark, sf_dir)
    return rows.filter(ingest.is_quarantined(F.col("disposition"))).select(F.col("disposition").alias("reason"), F.col("day").alias("date"), "event_id", "series_id")


_COUNTS = "count(*) AS parsed_rows, count(*) FILTER (disposition = 'output') AS output_rows, count(*) FILTER (disposition LIKE 'missing-%') AS quarantined_rows, count(*) FILTER (disposition = 'upper_boundary') AS upper_boundary_rows, count(*) FILTER (disposition = 'filtered_selection') AS filtered_selection_rows, count(*) FILTER (disposition = 'filtered_instrument') AS filtered_instrument_rows"


@query(sql(f"SELECT day AS date, {_COUNTS} FROM fate GROUP BY day", _FATE))
def disposition_summary(spark, sf_dir):
    return ingest.summary(classified(spark, sf_dir)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(sql(f"""SELECT count(DISTINCT day) FILTER (day BETWEEN '2024-01-01' AND '2024-01-20' AND (disposition = 'output' OR disposition LIKE 'missing-%')) AS completed_days, {_COUNTS}, 20::BIGINT AS requested_days,
    CASE WHEN count(DISTINCT day) FILTER (day BETWEEN '2024-01-01' AND '2024-01-20' AND (disposition = 'output' OR disposition LIKE 'missing-%')) = 20 THEN 'complete' ELSE 'incomplete' END AS status FROM fate""", _FATE))  # fmt: skip
def export_manifest(spark, sf_dir):
    """An export's manifest: the days' counts summed, and whether all days are there."""
    return export.rollup(ingest.summary(classified(spark, sf_dir)), datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 21, tzinfo=UTC))


@query(sql("""SELECT day AS date, count(*) FILTER (disposition LIKE 'missing-%') AS quarantined_rows, count(DISTINCT said) > 1 AS conflict,
    count(*) FILTER (disposition LIKE 'missing-%') > 0 OR count(DISTINCT said) > 1 AS requires_review
    FROM (SELECT *, CASE WHEN disposition = 'output' AND sensor = 'error' THEN CASE WHEN user_id % 5 = 0 AND day > '2024-01-10' THEN 'K' ELSE 'C' END END AS said FROM fate) GROUP BY day""", _FATE))  # fmt: skip
def export_review(spark, sf_dir):
    """Which days' exports someone must look at: rows in quarantine, or a variable that is described in two ways."""
    done = classified(spark, sf_dir)
    days = ingest.summary(done).select(F.date_format("date", "yyyy-MM-dd").alias("date"), "quarantined_rows")
    units = F.when((F.col("user_id") % 5 == 0) & (F.col("day") > "2024-01-10"), "K").otherwise("C")
    kept = done.filter((F.col("disposition") == ingest.OUTPUT) & (F.col("sensor") == "error")).withColumn("units", units)
    # the days stand where sensors do: conflicts are found within each
    found = catalog.metadata_conflicts(kept.select(F.col("day").alias("sensor"), "measurement", F.array("field").alias("fields"), "units").distinct(), ["units"])
    conflicts = found.groupBy(F.col("sensor").alias("date")).agg(F.count("*").alias("n"))
    joined = days.join(conflicts, "date", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.select("date", "quarantined_rows", (F.col("n") > 0).alias("conflict"), export.review(F.col("quarantined_rows"), F.col("n")).alias("requires_review"))


@query(sql("SELECT measurement, count(*) AS rows FROM fate WHERE disposition = 'output' GROUP BY measurement", _FATE))
def kept_measurements(spark, sf_dir):
    return ingest.kept_counts(classified(spark, sf_dir), "measurement", by_day=False)


@query(sql("SELECT DISTINCT measurement FROM ev WHERE measurement IN (SELECT measurement FROM ev WHERE " + _MATCH + ") OR measurement IN ('evt.click', 'evt.view')"))
def measurement_discovery(spark, sf_dir):
    return _SELECTION.measurements(events(spark, sf_dir).select("measurement", "field", "tags"))


# ---------------------------------------------------------------- catalogs


def _named(spark, sf_dir):
    return facts(spark, sf_dir).filter("vsn is not null and sensor is not null")


_NAMED = "f AS (SELECT * FROM ev WHERE vsn IS NOT NULL AND sensor IS NOT NULL)"
_SPAN = "min(time_ns) AS minimum_time, max(time_ns) AS maximum_time"


@query(sql(f"SELECT sensor, vsn, instrument_id, day AS date, count(*) AS row_count, {_SPAN}, count(DISTINCT measurement) AS measurements, count(DISTINCT field) AS fields, count(DISTINCT value_type) AS value_types FROM f GROUP BY ALL", _NAMED))
def partition_stats(spark, sf_dir):
    return catalog.partition_stats(_named(spark, sf_dir)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(sql(f"""SELECT sensor, vsn, instrument_id, day AS date, count(*) AS row_count, {_SPAN}, string_agg(DISTINCT measurement, ',' ORDER BY measurement) AS variables,
    'evt.' || sensor || '=' || count(*) AS measurements, 'value=' || count(*) AS fields, 'float64=' || count(*) AS value_types FROM f GROUP BY sensor, vsn, instrument_id, day""", _NAMED))  # fmt: skip
def partition_manifest(spark, sf_dir):
    """What each partition's manifest counts, by measurement, field, value type and variable."""
    found = catalog.partition_manifests(_stats(spark, sf_dir))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(c)
    return found.select("sensor", "vsn", "instrument_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "row_count", "minimum_time", "maximum_time", F.array_join(F.col("variables.measurement"), ",").alias("variables"), *map(text, ("measurements", "fields", "value_types")))


@query(sql(f"SELECT series_id, {_SPAN}, string_agg(DISTINCT field, ',') AS fields, string_agg(DISTINCT value_type, ',') AS value_types, any_value(measurement) AS measurement FROM ev GROUP BY series_id"))
def series_stats(spark, sf_dir):
    found = catalog.series(facts(spark, sf_dir), "measurement")
    return found.withColumns({c: F.array_join(c, ",") for c in ("fields", "value_types")})


def _stats(spark, sf_dir):
    return catalog.partition_variables(_named(spark, sf_dir))


@query(sql(f"SELECT sensor, count(DISTINCT vsn) AS vsns, count(DISTINCT instrument_id) AS instruments, count(*) AS rows, {_SPAN} FROM f GROUP BY sensor", _NAMED))
def sensor_catalog(spark, sf_dir):
    return catalog.sensors(_stats(spark, sf_dir))


@query(sql(f"SELECT sensor, vsn, instrument_id, count(*) AS rows, {_SPAN} FROM f GROUP BY ALL", _NAMED))
def instrument_catalog(spark, sf_dir):
    return catalog.instruments(_stats(spark, sf_dir))


@query(sql("SELECT sensor || '::' || measurement || '::' || field AS variable_id, sensor, measurement, field, count(*) AS rows FROM f GROUP BY ALL", _NAMED))
def variable_catalog(spark, sf_dir):
    return catalog.variables(_stats(spark, sf_dir))


@query(sql("SELECT instrument_id || '::' || measurement || '::' || field AS variable_id, sensor, vsn, instrument_id, measurement, field, count(*) AS rows FROM f GROUP BY ALL", _NAMED))
def instrument_variable_catalog(spark, sf_dir):
    return catalog.instrument_variables(_stats(spark, sf_dir))


@query(sql(f"SELECT series_id, {_SPAN}, string_agg(DISTINCT f2, ',' ORDER BY f2) AS fields, any_value(measurement) AS measurement FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'value' ELSE 'odd' END AS f2 FROM ev) GROUP BY series_id"))
def series_catalog_merge(spark, sf_dir):
    """The series of two runs (even and odd ids) merged."""
    rows = facts(spark, sf_dir).withColumn("field", F.when(F.col("event_id") % 2 == 0, "value").otherwise("odd"))
    runs = [catalog.series(rows.filter(F.col("event_id") % 2 == k), "measurement") for k in (0, 1)]
    return catalog.merge_series(runs[0].unionByName(runs[1]), "measurement").select("series_id", "minimum_time", "maximum_time", F.array_join("fields", ",").alias("fields"), "measurement")


@query(sql("""SELECT sensor, measurement, field, array_to_string(list_sort(list(DISTINCT said)), ';') AS signatures FROM
    (SELECT *, '{"units":"' || CASE WHEN user_id % 5 = 0 AND sensor <> 'error' THEN 'K' ELSE 'C' END || '","missing":"-9999.9"}' AS said FROM f) GROUP BY sensor, measurement, field HAVING count(DISTINCT said) > 1""", _NAMED))  # fmt: skip
def metadata_conflicts(spark, sf_dir):
    rows = _named(spark, sf_dir).withColumns({"units": F.when((F.col("user_id") % 5 == 0) & (F.col("sensor") != "error"), "K").otherwise("C"), "missing": F.lit("-9999.9")})
    found = catalog.metadata_conflicts(rows.groupBy("sensor", "measurement", "series_id", "units", "missing").agg(F.collect_set("field").alias("fields")), ["units", "missing"])
    return found.withColumn("signatures", F.array_join("signatures", ";"))


@query(sql("SELECT zone, count(*) AS n, count(DISTINCT series_id) AS series FROM ev GROUP BY zone"))
def facts_series_join(spark, sf_dir):
    """Facts that carry only a series id, joined to the series' tags."""
    rows = facts(spark, sf_dir)
    series = rows.groupBy("series_id").agg(F.first("tags").alias("tags"))
    joined = catalog.with_series(rows.select("series_id", "time_ns"), series)
    return joined.groupBy(F.try_element_at("tags", F.lit("zone")).alias("zone")).agg(F.count("*").alias("n"), F.count_distinct("series_id").alias("series"))


# ---------------------------------------------------------------- inventory

_ENTRIES = "e AS (SELECT *, time_ns AS minimum_time, time_ns + 1000 AS maximum_time, 'shard-' || (event_id % 7)::VARCHAR AS source FROM ev)"
_TIMES = "min(minimum_time) AS minimum_time, max(maximum_time) AS maximum_time"
_RESOLVED = f"r AS (SELECT series_id, measurement, field, any_value(sensor) AS sensor, any_value(vsn) AS vsn, any_value(instrument_id) AS instrument_id, any_value(zone) AS zone, {_TIMES}, count(*) AS blocks, min_by(source, event_id) AS first_source, max_by(source, event_id) AS last_source FROM e GROUP BY series_id, measurement, field)"


def _entries(spark, sf_dir):
    return facts(spark, sf_dir).withColumns({"minimum_time": F.col("time_ns"), "maximum_time": F.col("time_ns") + 1000, "source": F.concat(F.lit("shard-"), (F.col("event_id") % 7).cast("string")), "ordinal": F.col("event_id")})


def _resolved(spark, sf_dir):
    return inventory.rollup(_entries(spark, sf_dir), "series_id", "measurement", "field", "sensor", "vsn", "instrument_id", "zone")


@query(sql("SELECT series_id, measurement, field, minimum_time, maximum_time, blocks, first_source, last_source FROM r", _ENTRIES, _RESOLVED))
def index_rollup(spark, sf_dir):
    return inventory.rollup(_entries(spark, sf_dir), "series_id", "measurement", "field")


@query(sql(f"SELECT instrument_id, vsn, zone, {_TIMES}, count(*) AS series, count(DISTINCT (measurement, field)) AS variables FROM r GROUP BY instrument_id, vsn, zone", _ENTRIES, _RESOLVED))
def instrument_inventory(spark, sf_dir):
    return inventory.instruments(_resolved(spark, sf_dir), "instrument_id", "vsn", "zone")


@query(sql(f"SELECT instrument_id, measurement, field, array_to_string(list_sort(list(DISTINCT coalesce(zone, 'none'))), ',') AS units, '-9999.9' AS missing, {_TIMES}, sum(blocks)::BIGINT AS blocks FROM r GROUP BY instrument_id, measurement, field", _ENTRIES, _RESOLVED))
def variable_inventory(spark, sf_dir):
    rows = _resolved(spark, sf_dir).withColumns({"units": F.coalesce("zone", F.lit("none")), "missing": F.lit("-9999.9")})
    return inventory.instrument_variables(rows, "instrument_id")


@query(sql(f"SELECT measurement, field, count(DISTINCT instrument_id) AS instruments, count(*) AS series, {_TIMES} FROM r GROUP BY measurement, field", _ENTRIES, _RESOLVED))
def measurement_inventory(spark, sf_dir):
    return inventory.measurements(_resolved(spark, sf_dir))


@query(sql("SELECT DISTINCT measurement FROM r WHERE measurement ILIKE 'EVT.C%' OR lower(coalesce(sensor, '')) = 'view'", _ENTRIES, _RESOLVED))
def family_list(spark, sf_dir):
    return inventory.family(_resolved(spark, sf_dir), "EVT.C", "view", "measurement")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus")
def status_counts(spark, sf_dir):
    return inventory.status_counts(_read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "status"))


# ---------------------------------------------------------------- periods, shards, resume


#: A range whose first and last periods are clipped.
_FROM, _TO = datetime(2024, 1, 1, 1, 30, tzinfo=UTC), datetime(2024, 1, 28, 12, 15, tzinfo=UTC)


def _periods(spark, sf_dir, unit):
    period = times.period_of(F.col("time_ns"), _FROM, _TO, unit)
    rows = events(spark, sf_dir).select("time_ns", period.alias("p")).filter("p is not null").groupBy("p").agg(F.count("*").alias("n"), F.max("time_ns").alias("last_ns"))
    return rows.select(times.period_id(F.col("p.start"), F.col("p.end")).alias("period_id"), F.col("p.start").alias("period_start_ns"), F.col("p.end").alias("period_end_ns"), "n", "last_ns")


def _period_sql(unit):
    low, high = times.to_ns(_FROM), times.to_ns(_TO)
    text = lambda c: f"strftime(make_timestamp({c} // 1000), '%Y%m%dT%H%M%SZ')"
    start = f"greatest(epoch_us(date_trunc('{unit}', make_timestamp(time_ns // 1000))) * 1000, {low})"
    end = f"least(epoch_us(date_trunc('{unit}', make_timestamp(time_ns // 1000)) + INTERVAL 1 {unit}) * 1000, {high})"
    inner = f"p AS (SELECT {start} AS a, {end} AS b, time_ns FROM ev WHERE time_ns >= {low} AND time_ns < {high})"
    return sql(f"SELECT {text('a')} || '_' || {text('b')} AS period_id, a AS period_start_ns, b AS period_end_ns, count(*) AS n, max(time_ns) AS last_ns FROM p GROUP BY a, b", inner)


@query(_period_sql("hour"))
def period_split_hour(spark, sf_dir):
    return _periods(spark, sf_dir, "1h")


@query(_period_sql("day"))
def period_split_day(spark, sf_dir):
    return _periods(spark, sf_dir, "1d")


@query(_period_sql("month"))
def period_split_month(spark, sf_dir):
    return _periods(spark, sf_dir, "1month")


@query(_period_sql("year"))
def period_split_year(spark, sf_dir):
    return _periods(spark, sf_dir, "1year")


_SHARDS = "s AS (SELECT o_orderkey AS shard, o_orderdate::DATE AS d0, (o_orderdate::DATE + (o_orderkey % 5 + 1)::INT)::DATE AS d1 FROM orders)"


def _shards(spark, sf_dir):
    o = _read(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(F.col("o_orderkey").alias("shard"), d.alias("d0"), F.date_add(d, (F.col("o_orderkey") % 5 + 1).cast("int")).alias("d1"))


@query(f"WITH {_SHARDS} SELECT shard, strftime(unnest(generate_series(d0, d1 - 1, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM s")
def day_expansion(spark, sf_dir):
    """The days of half-open ranges."""
    return ranges.expanded(_shards(spark, sf_dir), "d0", "d1").select("shard", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(f"WITH {_SHARDS} SELECT shard, strftime(greatest(d0, DATE '1996-03-01'), '%Y-%m-%d') AS first, strftime(least(d1, DATE '1997-02-01'), '%Y-%m-%d') AS past FROM s WHERE greatest(d0, DATE '1996-03-01') < least(d1, DATE '1997-02-01')")
def shard_overlap(spark, sf_dir):
    """Shards clipped to a range, without those outside it."""
    found = ranges.overlapping(_shards(spark, sf_dir), "d0", "d1", date(1996, 3, 1), date(1997, 2, 1))
    return found.select("shard", F.date_format("d0", "yyyy-MM-dd").alias("first"), F.date_format("d1", "yyyy-MM-dd").alias("past"))


@query(sql("SELECT DISTINCT vsn, day FROM f WHERE NOT (event_id % 1 = 0 AND ascii(substr(vsn, 4, 1)) % 2 = 0 AND day < '2024-01-10')", _NAMED))
def resume_pending(spark, sf_dir):
    """Work (node and day) without a marker."""
    work = _named(spark, sf_dir).select("vsn", "day").distinct()
    done = work.filter("ascii(substr(vsn, 4, 1)) % 2 = 0 and day < '2024-01-10'")
    return inventory.pending(work, done, "vsn", "day")


@query(sql("SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-10', INTERVAL 1 DAY)) AS d) WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT day FROM ev)"))
def missing_dates(spark, sf_dir):
    wanted = spark.range(1).select(F.explode(F.expr("sequence(date'2023-12-25', date'2024-02-10')")).alias("d")).select(F.date_format("d", "yyyy-MM-dd").alias("day"))
    return ranges.missing_days(wanted, facts(spark, sf_dir))


@query("SELECT n_name AS name, n_regionkey::DOUBLE AS region, NULL::DOUBLE AS balance FROM nation UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier")
def union_by_name(spark, sf_dir):
    a = _read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("double").alias("region"))
    b = _read(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


# ---------------------------------------------------------------- files written and read again


@query(sql("""SELECT measurement, f AS field, t AS value_type, count(*) AS n, count(DISTINCT series_id) AS series, count(DISTINCT instrument_id) AS instruments, min(time_ns) AS first_ns
    FROM ev, (VALUES ('value', 'float64'), ('event id', 'int64'), ('user', 'uint64'), ('even', 'bool'), ('props', 'string')) AS x(f, t) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL"""))  # fmt: skip
def lp_files(spark, sf_dir):
    """Files of line protocol, with records over several lines, read by splits; identities come from the parser."""
    folder = store.scratch(spark, "lines")
    lines(spark, sf_dir).write.text(folder)
    points = line_protocol.read_files(spark, folder)
    return points.groupBy("measurement", "field", "value_type").agg(F.count("*").alias("n"), F.count_distinct("series_id").alias("series"), F.count_distinct("instrument_id").alias("instruments"), F.min("time_ns").alias("first_ns"))


@query(sql("SELECT measurement, sensor, vsn, zone, count(*) AS blocks, min(time_ns) AS minimum_time, max(time_ns + 1000) AS maximum_time FROM ev GROUP BY ALL"))
def index_dump(spark, sf_dir):
    """The rows of an index dump, parsed and rolled up by series."""
    rows = tables.parse_index(_dump(spark, sf_dir))
    tag = lambda k: F.try_element_at("tags", F.lit(k)).alias(k)
    entries = rows.select("measurement", *map(tag, SERIES[1:]), "minimum_time", "maximum_time", F.lit("dump").alias("source"), F.lit(0).alias("ordinal"))
    return inventory.rollup(entries, *SERIES).drop("first_source", "last_source")


def _dump(spark, sf_dir):
    """The lines of an index dump, a row for each event."""
    e = events(spark, sf_dir)
    key = F.concat_ws(",", "measurement", F.lit("node=n1"), *(F.concat(F.lit(f"{k}="), F.replace(F.col(k), F.lit(" "), F.lit("\\ "))) for k in SERIES[1:]))
    t = F.col("time_ns")
    text = F.concat_ws("\t", F.concat(F.lit("  "), F.col("event_id").cast("string")), times.rfc3339(t), times.rfc3339(t + 1000), F.lit("5"), F.lit("9"), key, F.lit("value"))
    header = spark.createDataFrame([("Index:",), ("  Pos\tMin Time\tMax Time\tOfs\tSize\tKey\tField",)], "value string")
    return header.unionByName(line_protocol.spread(e.select(text.alias("value")), "value"))


@query("SELECT o_orderstatus AS bucket_id, o_orderkey AS shard_id, 's' || o_orderkey || '.tar.gz' AS file, o_custkey AS size, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS start FROM orders")
def backup_manifest(spark, sf_dir):
    """The shards of a backup's manifests, of each status of orders, gathered in files with a manifest on each line."""
    folder = store.scratch(spark, "manifests")
    shard = F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string"), F.lit(".tar.gz")).alias("fileName"), F.col("o_custkey").alias("size"))
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    group = F.struct(start.alias("startTime"), start.alias("endTime"), F.array(shard).alias("shards"))
    policies = F.array(F.struct(F.collect_list(group).alias("shardGroups")))
    # some hundred shards to a document, as no manifest holds a whole table
    some = _read(spark, sf_dir, "orders").groupBy("o_orderstatus", F.expr("o_orderkey div 512").alias("part")).agg(policies.alias("p"))
    some.select(F.array(F.struct(F.col("o_orderstatus").alias("bucketID"), F.col("p").alias("retentionPolicies"))).alias("buckets")).write.json(folder)
    return tables.backup_shards(spark, folder, lines=True).drop("end")


#: Ten nodes at a time as one, without zones: some hundred partitions, as large as they are in use.
_NODES = """n AS (SELECT * EXCLUDE (vsn, instrument_id), substr(vsn, 1, 3) AS vsn, substr(vsn, 1, 3) || '--' || sensor || '--unknown-zone--' ||
    substr(sha256('{"device": "unknown-device", "kind": "' || sensor || '", "vsn": "' || substr(vsn, 1, 3) || '", "zone": "unknown-zone"}'), 1, 12) AS instrument_id FROM ev WHERE vsn IS NOT NULL AND sensor IS NOT NULL)"""


def _nodes(spark, sf_dir):
    vsn = F.substring("vsn", 1, 3)
    tags = F.create_map(F.lit("sensor"), F.col("sensor"), F.lit("vsn"), vsn, F.lit("node"), F.lit("n1"))
    return events(spark, sf_dir).filter("vsn is not null and sensor is not null").withColumns({"vsn": vsn, "tags": tags})


@query(sql(f"SELECT sensor, vsn, instrument_id, day AS date, count(*) AS n, {_SPAN}, sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END)::BIGINT AS nans FROM n GROUP BY ALL", _NODES))
def store_roundtrip(spark, sf_dir):
    """Facts written by sensor, node, instrument and day, and read again with their files."""
    root = store.scratch(spark, "facts")
    named = ingest.identified(_nodes(spark, sf_dir).drop("sensor", "vsn"))
    store.write_facts(named.select("time_ns", "sensor", "vsn", "instrument_id", "measurement", "field", "series_id", "value"), root)
    back = tables.read_facts(spark, f"{root}/facts/**/*.parquet").filter(F.col("_source_file").contains("date=") & (F.col("instrument") == F.col("instrument_id")))
    return back.groupBy("sensor", "vsn", "instrument_id", "date").agg(F.count("*").alias("n"), F.min("time_ns").alias("minimum_time"), F.max("time_ns").alias("maximum_time"), F.sum(F.coalesce(F.isnan("value"), F.lit(False)).cast("long")).alias("nans"))


_WANTED = Selection.from_document({"selection_version": 2, "selectors": [{"measurement": "evt.click", "tags": {"vsn": ["W0[0-4]"]}}, {"measurement_glob": "evt.?r*", "fields": ["val*"]}]})
_IS_WANTED = "((measurement = 'evt.click' AND vsn < 'W05') OR regexp_full_match(measurement, 'evt\\..r.*'))"


@query(sql(f"SELECT sensor, vsn, instrument_id, day AS date, count(*) AS row_count, {_SPAN}, 'complete' AS status FROM n WHERE time_ns < {END_NS} AND {_IS_WANTED} GROUP BY ALL", _NODES))
def export_resume(spark, sf_dir):
    """An export of days that is made, and made again without publishing anything twice; what its manifests say."""
    root = store.scratch(spark, "export")
    values = [F.col("value").alias("value_float64"), *(F.lit(None).cast(t).alias(f"value_{k}") for k, t in schema.VALUE_COLUMNS.items() if k != "float64")]
    points = _nodes(spark, sf_dir).select("measurement", "tags", "time_ns", "field", "value_type", *values)
    start, end = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 21, tzinfo=UTC)
    for run_id in ("r1", "r2"):
        export.export_days(points, root, run_id, start, end, _WANTED, on_existing="skip")
    return export.manifests(spark, root).select("sensor", "vsn", "instrument_id", "date", "row_count", "minimum_time", "maximum_time", "status")


@query(sql(f"""SELECT variable, variable || suffix AS check_id, flag_name, bit, count(time_ns) AS units_tested, coalesce(sum(CASE WHEN time_ns IS NOT NULL AND {_FAILED} THEN 1 ELSE 0 END), 0)::BIGINT AS units_failed
    FROM checks LEFT JOIN (SELECT * FROM obs WHERE day BETWEEN '2024-01-03' AND '2024-01-19') AS o USING (variable) GROUP BY ALL""", _OBS, _CHECKS))  # fmt: skip
def run_store(spark, sf_dir):
    """A run over a store of facts, a period for each day, resumed once, and the report of its periods."""
    root = store.scratch(spark, "run")
    facts(spark, sf_dir).select(*KEYS, "measurement", "field", "value").write.parquet(f"{root}/facts")
    document = {
        "schema_version": 1, "source": {"path": f"{root}/facts", "time": {"column": "time_ns"}, "observation_keys": list(KEYS)}, "quality": {"rules": "rules.yaml"}, "processing": {"period": "1d"},
        "selection": {"start": "2024-01-03T00:00:00Z", "end": "2024-01-20T00:00:00Z"}, "work_units": [{"id": "all", "profile": "events"}], "output": {"root": f"{root}/out"},
    }
    run = Run.from_document(document)
    made = runner.run_new(spark, RULES, run, "r1")
    made.files.delete(made.place(run.work_units[0], next(iter(times.iter_periods(run.start, run.end, run.period)))))
    return runner.report(runner.resume(spark, RULES, run, "r1"), run).select("variable", "check_id", "flag_name", "bit", "units_tested", "units_failed")


# ---------------------------------------------------------------- storage files

_FIELDS = ("('value', 'float64', round(value * 100)::BIGINT), ('event id', 'int64', event_id), ('user', 'uint64', user_id), "
           "('even', 'bool', (event_id % 2 = 0)::BIGINT), ('props', 'string', length(props))")  # fmt: skip
_STORED = f"st AS (SELECT ev.*, f AS stored_field, t AS stored_type, n AS amount FROM ev, LATERAL (VALUES {_FIELDS}) AS x(f, t, n) WHERE value IS NOT NULL AND NOT isnan(value))"


def stored_points(spark, sf_dir):
    """Five typed points of each event that has a value."""
    e = events(spark, sf_dir).filter("value is not null and not isnan(value)")
    cells = {"float64": F.col("value"), "int64": F.col("event_id"), "uint64": F.col("user_id"), "bool": F.col("event_id") % 2 == 0, "string": F.col("props")}
    names = {"float64": "value", "int64": "event id", "uint64": "user", "bool": "even", "string": "props"}
    value = lambda kind, k: (cells[k] if k == kind else F.lit(None)).cast(schema.VALUE_COLUMNS[k]).alias(f"value_{k}")
    rows = F.array(*[F.struct(F.lit(names[kind]).alias("field"), F.lit(kind).alias("value_type"), *[value(kind, k) for k in schema.VALUE_TYPES]) for kind in schema.VALUE_TYPES])
    return e.select("measurement", "tags", "time_ns", F.inline(rows))


def _amounts(points):
    """What the values of each type add up to, as whole numbers."""
    amount = F.coalesce(F.round(F.col("value_float64") * 100).cast("long"), "value_int64", F.col("value_uint64").cast("long"), F.col("value_bool").cast("long"), F.length("value_string").cast("long"))
    return points.groupBy("measurement", "field", "value_type").agg(F.count("*").alias("n"), F.count_distinct("series_id").alias("series"), F.count_distinct("instrument_id").alias("instruments"), F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"), F.sum(amount).alias("amount"))


_STORED_WANTED = Selection.from_document({"selection_version": 2, "selectors": [{"measurement": "evt.click", "tags": {"vsn": ["W0[0-4]*"]}}, {"measurement_glob": "evt.?[ir]*", "fields": ["val*", "e*"]}]})
_IS_STORED_WANTED = "((measurement = 'evt.click' AND vsn < 'W05') OR (regexp_full_match(measurement, 'evt\\..[ir].*') AND (stored_field LIKE 'val%' OR stored_field LIKE 'e%')))"
_LOW, _HIGH = times.to_ns(datetime(2024, 1, 5, 7, tzinfo=UTC)), times.to_ns(datetime(2024, 1, 19, tzinfo=UTC))


@query(sql(f"""SELECT measurement, stored_field AS field, stored_type AS value_type, count(*) AS n, count(DISTINCT series_id) AS series, count(DISTINCT instrument_id) AS instruments, min(time_ns) AS first_ns,
    max(time_ns) AS last_ns, sum(amount)::BIGINT AS amount FROM st WHERE time_ns >= {_LOW} AND time_ns < {_HIGH} AND {_IS_STORED_WANTED} GROUP BY ALL""", _STORED))  # fmt: skip
def shard_scan(spark, sf_dir):
    """Storage files written from events and scanned: a range and a selection prune blocks by their footers."""
    folder = store.mounted(spark, "shards")
    tsm.write(stored_points(spark, sf_dir), folder, 8)
    return _amounts(tsm.scan(spark, folder, _LOW, _HIGH, _STORED_WANTED.takes))


@query(sql("""SELECT measurement, sensor, vsn, zone, stored_field AS field, stored_type AS value_type, min(time_ns) AS minimum_time, max(time_ns) AS maximum_time FROM st
    GROUP BY measurement, sensor, vsn, zone, stored_field, stored_type""", _STORED))  # fmt: skip
def shard_index(spark, sf_dir):
    """The series of storage files, from footers alone, and rolled up without the tag that is no part of a series."""
    folder = store.mounted(spark, "shards")
    tsm.write(stored_points(spark, sf_dir), folder, 8)
    found = tsm.series_index(tsm.index(spark, folder))
    tags = [F.try_element_at("tags", F.lit(k)).alias(k) for k in SERIES[1:]]
    return found.select("measurement", *tags, "field", "value_type", "minimum_time", "maximum_time").groupBy("measurement", *SERIES[1:], "field", "value_type").agg(F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"))


#: Shards of a backup: half-open days of January 2024.
_BACKUP_SHARDS = ((1, 8), (8, 15), (15, 22))


def _backup(spark, sf_dir, folder):
    """A backup of three shards, with an archive for each."""
    # ten nodes at a time as one, as in the stores below: some hundred partitions
    points = _nodes(spark, sf_dir).filter("value is not null and not isnan(value)").select("measurement", "tags", "time_ns", "field", "value_type", F.col("value").alias("value_float64"), *(F.lit(None).cast(t).alias(f"value_{k}") for k, t in schema.VALUE_COLUMNS.items() if k != "float64"))
    shards, owner = [], []
    for number, days in enumerate(_BACKUP_SHARDS, 1):
        low, high = (datetime(2024, 1, d, tzinfo=UTC) for d in days)
        owner.append(F.when(F.col("time_ns").between(times.to_ns(low), times.to_ns(high) - 1), f"b1/autogen/{number}"))
        shards.append({"id": number, "path": f"{folder}/s{number}.tar.gz", "size": 1000, "start": low, "end": high})
    # all shards in one pass over the events
    tsm.write(points.withColumn("shard", F.coalesce(*owner)).filter("shard is not null"), f"{folder}/engine", 2 * len(shards), below="shard")
    backup.archive(spark, [(s["path"], f"{folder}/engine", f"b1/autogen/{s['id']}") for s in shards])
    return {"bucket_id": "b1", "name": "events", "snapshot": "s", "shards": shards}


@query(sql(f"""SELECT sensor, vsn, instrument_id, day AS date, count(*) AS row_count, {_SPAN}, 'complete' AS status FROM n
    WHERE value IS NOT NULL AND NOT isnan(value) AND day >= '2024-01-03' AND day < '2024-01-20' AND {_IS_WANTED} GROUP BY ALL""", _NODES))  # fmt: skip
def backup_export(spark, sf_dir):
    """The archives of a backup exported as one job, and again without reading an archive; what the manifests say."""
    folder, root = store.mounted(spark, "shards"), store.scratch(spark, "export")
    made = _backup(spark, sf_dir, folder)
    for _ in range(2):
        backup.export_backup(spark, made, root, date(2024, 1, 3), date(2024, 1, 20), selection=_WANTED)
    return export.manifests(spark, root).select("sensor", "vsn", "instrument_id", "date", "row_count", "minimum_time", "maximum_time", "status")


# ---------------------------------------------------------------- level-1 files


@query(sql("SELECT day, variable, coalesce(bits, 0)::VARCHAR AS qc_bits, count(*) AS n, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing, min(time_ns) AS first_ns, max(time_ns) AS last_ns, sum(round(coalesce(v, 0) * 100)::BIGINT)::BIGINT AS hundredths, count(DISTINCT series_id) AS series FROM obs LEFT JOIN masks USING (time_ns, series_id, variable) GROUP BY ALL", _OBS, _CHECKS, _FIND, _MASKS))
def level1_files(spark, sf_dir):
    """A level-1 file for each day, written by many tasks at planned places, and read again by ranges of rows."""
    rows = _flagged(spark, sf_dir).withColumn("series_id", F.unhex("series_id"))
    folder = store.mounted(spark, "level1")
    days = [r.day for r in rows.select("day").distinct().collect()]
    paths = {day: f"{folder}/{day}.nc" for day in days}
    level1.write_files(rows, "day", RULES, PROFILE, KEYS, paths, {day: {"title": f"events of {day}"} for day in days})
    back = cdf.read(spark, list(paths.values()))
    names = F.create_map(*[F.lit(x) for name, code in level1.variable_codes(PROFILE).items() for x in (code, name)])
    v = F.when(~F.isnan("observed_value"), F.col("observed_value"))
    keyed = back.select(F.regexp_extract("file", r"([^/]+)\.nc$", 1).alias("day"), F.element_at(names, F.col("variable")).alias("variable"), F.col("qc_bits").cast("string").alias("qc_bits"), "time_ns", "series_id", v.alias("v"))
    return keyed.groupBy("day", "variable", "qc_bits").agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("missing"), F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"), F.sum(F.round(F.coalesce("v", F.lit(0.0)) * 100).cast("long")).alias("hundredths"), F.count_distinct("series_id").alias("series"))


# ---------------------------------------------------------------- many rules, selectors and ranges

_RULE_TAGS = "CASE o_orderkey % 3 WHEN 0 THEN {a} WHEN 1 THEN {b} ELSE {c} END"
_RULES = """rules AS (SELECT o_orderkey AS number, 'o' || o_orderkey AS id, o_orderkey % 3 AS shape, 'W' || lpad((o_custkey % 80)::VARCHAR, 3, '0') AS rv,
    ['click', 'error', 'view', 'none'][1 + o_orderkey // 3 % 4] AS rs, ['core', 'shield roof', 'none'][1 + o_orderkey // 12 % 3] AS rz FROM orders),
f2 AS (SELECT min(number) AS first, vsn, sensor, zone FROM rules JOIN (SELECT DISTINCT measurement, sensor, vsn, zone FROM ev) ON
    (shape = 0 AND rv = vsn AND rs = sensor) OR (shape = 1 AND rv = vsn AND rz = zone AND number % 5 = 1) OR (shape = 2 AND rv = vsn AND rs = sensor AND rz = zone) GROUP BY vsn, sensor, zone)"""


@query(sql("SELECT measurement, ev.sensor, ev.vsn, ev.zone, 'o' || first AS listed, count(*) AS n FROM ev LEFT JOIN f2 ON ev.vsn IS NOT DISTINCT FROM f2.vsn AND ev.sensor IS NOT DISTINCT FROM f2.sensor AND ev.zone IS NOT DISTINCT FROM f2.zone GROUP BY ALL", _RULES))
def registry_rules(spark, sf_dir):
    """A rule for each order, of three shapes, asked for all series of events: the first that agrees."""
    o = _read(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    vsn = F.concat(F.lit("W"), F.lpad((F.col("o_custkey") % 80).cast("string"), 3, "0"))
    one = lambda values, by: F.element_at(F.array(*map(F.lit, values)), (F.expr(f"o_orderkey div {by}") % len(values) + 1).cast("int"))
    sensor, zone = one(("click", "error", "view", "none"), 3), one(("core", "shield roof", "none"), 12)
    pair = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)])
    match = F.when(n % 3 == 0, pair(vsn=vsn, sensor=sensor)).when(n % 3 == 2, pair(vsn=vsn, sensor=sensor, zone=zone)).when(n % 5 == 1, pair(vsn=vsn, zone=zone)).otherwise(pair(vsn=vsn, zone=zone, never=F.lit("x")))
    rules = o.select(n.alias("number"), F.concat(F.lit("o"), n.cast("string")).alias("instrument_id"), match.alias("match"))
    tags = F.map_filter(F.create_map(*(x for k in SERIES[1:] for x in (F.lit(k), F.col(k)))), lambda _, v: v.isNotNull())
    series = events(spark, sf_dir).groupBy(*SERIES).agg(F.count("*").alias("n")).withColumn("tags", tags)
    return registry.listed(series, rules, list(SERIES)).drop("tags")


_PATTERNS = """pat AS (SELECT DISTINCT 'evt.' || ['c', 'e', 'v', 'z'][1 + c_custkey % 4] || '%' AS m, 'W' || lpad((c_custkey // 4 % 70)::VARCHAR, 3, '0') AS v, ['core', 'shield%', '%roof', 'none'][1 + c_nationkey % 4] AS z FROM customer),
hit AS (SELECT DISTINCT measurement, vsn, zone FROM (SELECT DISTINCT measurement, vsn, zone FROM ev) JOIN pat ON vsn = v AND measurement LIKE m AND zone LIKE z)"""


@query(sql("SELECT measurement, vsn, zone, count(*) AS n, min(time_ns) AS first_ns FROM ev JOIN hit USING (measurement, vsn, zone) GROUP BY ALL", _PATTERNS))
def selection_many(spark, sf_dir):
    """A selector for each kind of customer, asked for distinct series by one automaton for each column."""
    c = _read(spark, sf_dir, "customer")
    one = lambda values, by: F.element_at(F.array(*map(F.lit, values)), (F.col(by) % len(values) + 1).cast("int"))
    made = c.select(F.concat(F.lit("evt."), one(("c", "e", "v", "z"), "c_custkey"), F.lit("*")).alias("m"), F.concat(F.lit("W"), F.lpad((F.expr("c_custkey div 4") % 70).cast("string"), 3, "0")).alias("v"), one(("core", "shield*", "*roof", "none"), "c_nationkey").alias("z")).distinct()
    wanted = Selection.from_document({"selection_version": 2, "selectors": [{"measurement_glob": r.m, "tags": {"vsn": [r.v], "zone": [r.z]}} for r in made.collect()]})
    found = many_selectors.answered(events(spark, sf_dir), wanted).filter("_takes")
    return found.groupBy("measurement", "vsn", "zone").agg(F.count("*").alias("n"), F.min("time_ns").alias("first_ns"))


_ORDERED = "DATE '1970-01-01'"
_SPANS = f"""li AS (SELECT l_partkey AS k, l_shipdate::DATE - {_ORDERED} AS a0, l_shipdate::DATE - {_ORDERED} + l_quantity::BIGINT AS a1 FROM lineitem),
od AS (SELECT o_custkey AS k, o_orderdate::DATE - {_ORDERED} AS b0, o_orderdate::DATE - {_ORDERED} + o_orderkey % 40 AS b1 FROM orders)"""


def _spans(spark, sf_dir):
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("long")
    li = _read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), day("l_shipdate").alias("low"), (day("l_shipdate") + F.col("l_quantity").cast("long")).alias("high"))
    od = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), day("o_orderdate").alias("low"), (day("o_orderdate") + F.col("o_orderkey") % 40).alias("high"))
    return li, od


@query(f"WITH {_SPANS} SELECT k, count(*) AS pairs, sum(least(a1, b1) - greatest(a0, b0))::BIGINT AS days FROM li JOIN od USING (k) WHERE greatest(a0, b0) < least(a1, b1) GROUP BY k")
def range_join(spark, sf_dir):
    """Ranges of line items against ranges of orders that overlap, in bins, each pair once."""
    li, od = _spans(spark, sf_dir)
    found = ranges.joined(li, od, 32, ["k"])
    return found.groupBy("k").agg(F.count("*").alias("pairs"), F.sum(F.col("high") - F.col("low")).alias("days"))


@query(f"""WITH {_SPANS}, r AS (SELECT k, b0, max(b1) OVER (PARTITION BY k ORDER BY b0, b1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM od WHERE b0 < b1)
    SELECT k, reach AS low, b0 AS high FROM r WHERE b0 > reach""")  # fmt: skip
def range_gaps(spark, sf_dir):
    """Where, between a customer's first and last range, none of them is; swept in bins, no day has a row."""
    return ranges.gaps(_spans(spark, sf_dir)[1], 365, ["k"])


# ---------------------------------------------------------------- kept tables


@query(sql("SELECT variable, coalesce(bits, 0)::VARCHAR AS qc_bits, count(*) AS n, min(time_ns) AS first_ns FROM obs LEFT JOIN masks USING (time_ns, series_id, variable) GROUP BY ALL", _OBS, _CHECKS, _FIND, _MASKS))
def flag_attach_stored(spark, sf_dir):
    """Observations and the masks of their findings, stored in the same buckets: their join moves nothing."""
    seen = observations(spark, sf_dir)
    layout, folder, tag = buckets.Layout((*KEYS, "variable"), 8), store.scratch(spark, "buckets"), uuid.uuid4().hex
    kept = layout.write(seen.select(*KEYS, "variable", "observed_value", "observed_value_string"), f"observations_{tag}", f"{folder}/observations")
    masks = layout.write(qc.compile_masks(qc.findings(kept, PROFILE, RULES), KEYS), f"masks_{tag}", f"{folder}/masks")
    joined = qc.attach_masks(kept.hint("merge"), masks, KEYS)
    return joined.groupBy("variable", F.col("qc_bits").cast("string").alias("qc_bits")).agg(F.count("*").alias("n"), F.min("time_ns").alias("first_ns"))


@query(sql(f"SELECT sensor, vsn, instrument_id, day AS date, count(*) AS n, {_SPAN}, sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END)::BIGINT AS nans FROM n GROUP BY ALL", _NODES))
def commit_log(spark, sf_dir):
    """Three exports of overlapping days at the same time, by an optimistic log; the facts of its last snapshot."""
    data = commits.Dataset(spark, store.scratch(spark, "shared"))
    named = store.kept(ingest.identified(_nodes(spark, sf_dir).drop("sensor", "vsn")).select("time_ns", "sensor", "vsn", "instrument_id", "measurement", "field", "value_type", "series_id", "value"), "facts")
    day = F.date_format(times.date_of(F.col("time_ns")), "yyyy-MM-dd")
    runs = {"a": day < "2024-01-12", "b": (day >= "2024-01-08") & (day < "2024-01-20"), "c": day >= "2024-01-15"}
    with ThreadPoolExecutor(len(runs)) as pool:
        list(pool.map(lambda run: data.publish(named.filter(runs[run]), run, policy="skip"), runs))
    return data.facts().groupBy("sensor", "vsn", "instrument_id", "date").agg(F.count("*").alias("n"), F.min("time_ns").alias("minimum_time"), F.max("time_ns").alias("maximum_time"), F.count_if(F.isnan("value")).alias("nans"))


@query(sql("SELECT measurement, sensor, vsn, zone, count(*) AS blocks, min(time_ns) AS minimum_time, max(time_ns + 1000) AS maximum_time FROM ev GROUP BY ALL"))
def inventory_kept(spark, sf_dir):
    """An inventory that is kept, of eight dumps: made from seven and a broken one, and brought up to date when that is mended."""
    folder, root, lines_ = store.scratch(spark, "dumps"), store.scratch(spark, "inventory"), _dump(spark, sf_dir)
    part = F.pmod(F.xxhash64("value"), F.lit(8)).alias("part")
    lines_.select("value", part).repartition(8, "part").write.partitionBy("part").text(folder)
    spark.createDataFrame([("1\tbroken",)], "value string").coalesce(1).write.mode("append").text(f"{folder}/part=3")
    for _ in range(2):
        inventory.update(spark, f"{folder}/part=*/part-*", root)
    bad = inventory.sources(spark, root).filter("status = 'error'").select("source").collect()
    for r in bad:
        store.Files(spark).delete(r.source)
    inventory.update(spark, f"{folder}/part=*/part-*", root)
    tag = lambda k: F.try_element_at("tags", F.lit(k)).alias(k)
    rows = inventory.entries(spark, root).select("measurement", *map(tag, SERIES[1:]), "minimum_time", "maximum_time", "source", F.lit(0).alias("ordinal"))
    return inventory.rollup(rows, *SERIES).drop("first_source", "last_source")


_NAMELESS = """q AS (SELECT 'quarantine' AS what, CASE WHEN vsn IS NULL THEN 'missing-vsn' ELSE 'missing-sensor' END AS name, day AS date, count(*) AS n, count(DISTINCT measurement) AS measurements FROM ev
    WHERE vsn IS NULL OR sensor IS NULL GROUP BY ALL),
s AS (SELECT 'series' AS what, sensor AS name, strftime(make_timestamp(min(time_ns) // 1000), '%Y-%m-%d') AS date, 1::BIGINT AS n, count(DISTINCT measurement) AS measurements FROM ev
    WHERE vsn IS NOT NULL AND sensor IS NOT NULL GROUP BY sensor, substr(vsn, 1, 3))"""


@query(sql(f"SELECT * FROM q WHERE date < '{datetime(2024, 1, 21):%Y-%m-%d}' UNION ALL SELECT what, name, min(date), sum(n)::BIGINT, max(measurements) FROM (SELECT s.* FROM s) GROUP BY what, name", _NAMELESS))
def export_tables(spark, sf_dir):
    """What an export keeps beside its facts: quarantined rows by reason and day, and the series of each sensor."""
    root = store.scratch(spark, "export")
    vsn = F.substring("vsn", 1, 3)
    tags = F.map_filter(F.create_map(F.lit("sensor"), F.col("sensor"), F.lit("vsn"), vsn), lambda _, v: v.isNotNull())
    values = [F.col("value").alias("value_float64"), *(F.lit(None).cast(t).alias(f"value_{k}") for k, t in schema.VALUE_COLUMNS.items() if k != "float64")]
    points = events(spark, sf_dir).select("measurement", tags.alias("tags"), "time_ns", "field", "value_type", *values)
    export.export_days(points, root, "r1", datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 21, tzinfo=UTC))
    held = spark.read.option("basePath", f"{root}/_quarantine").parquet(f"{root}/_quarantine")
    date_ = F.col("date").cast("string").alias("date")
    nameless = held.groupBy(F.lit("quarantine").alias("what"), F.col("reason").alias("name"), date_).agg(F.count("*").alias("n"), F.count_distinct("measurement").alias("measurements"))
    series = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/_series")
    first = F.date_format(times.date_of(F.min("minimum_time")), "yyyy-MM-dd").alias("date")
    named = series.groupBy(F.lit("series").alias("what"), F.col("sensor").alias("name")).agg(first, F.count("*").alias("n"), F.lit(1).cast("long").alias("measurements"))
    return nameless.unionByName(named)


@query(sql(f"SELECT day, measurement, count(*) AS n, min(time_ns) AS first_ns, max(time_ns) AS last_ns, count(DISTINCT series_id) AS series FROM ev WHERE series_id < '04' AND time_ns >= {times.to_ns(datetime(2024, 1, 3, tzinfo=UTC))} AND time_ns < {times.to_ns(datetime(2024, 1, 11, 6, tzinfo=UTC))} GROUP BY ALL"))
def file_skipping(spark, sf_dir):
    """Facts of some series and days, from files that an index of zone maps and filters names."""
    folder, index = store.scratch(spark, "facts"), store.scratch(spark, "index")
    rows = facts(spark, sf_dir).select("time_ns", F.unhex("series_id").alias("series_id"), "measurement", "day")
    rows.repartitionByRange(32, "day", "series_id").write.parquet(folder)
    file_index.update(spark, folder, index)
    wanted = [bytes(r[0]) for r in rows.select("series_id").filter(F.lower(F.hex("series_id")) < "04").distinct().collect()]
    found = file_index.read(spark, folder, index, times.to_ns(datetime(2024, 1, 3, tzinfo=UTC)), times.to_ns(datetime(2024, 1, 11, 6, tzinfo=UTC)), wanted)
    found = spark.createDataFrame([], rows.schema) if found is None else found
    return found.groupBy("day", "measurement").agg(F.count("*").alias("n"), F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns"), F.count_distinct("series_id").alias("series"))


@query(sql("SELECT series_id, sensor, vsn, instrument_id, measurement, min(time_ns) AS minimum_time, max(time_ns) AS maximum_time FROM ev WHERE sensor IS NOT NULL AND vsn IS NOT NULL AND day <> '2024-01-09' GROUP BY ALL"))
def series_kept(spark, sf_dir):
    """A catalog of series that is kept over six exports: one replaces days of another, and a day is taken back."""
    named = store.kept(facts(spark, sf_dir).filter("sensor is not null and vsn is not null").withColumn("series_id", F.unhex("series_id")), "facts")
    kept = kept_series.KeptSeries(spark, store.scratch(spark, "series"))
    for low, high in (("2024-01-01", "2024-01-05"), ("2024-01-05", "2024-01-10"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-22"), ("2024-01-22", "9999")):
        kept.add(kept_series.rows_of(named.filter((F.col("day") >= low) & (F.col("day") < high))))
    kept.retract(named.filter("day = '2024-01-09'").select("sensor", "vsn", "instrument_id", F.col("day").alias("date")))
    return kept.series().select(F.lower(F.hex("series_id")).alias("series_id"), "sensor", "vsn", "instrument_id", "measurement", "minimum_time", "maximum_time")
