"""Table schemas of the engine.

Nanosecond times are longs (``time_ns``), as Spark's timestamps end at
microseconds; unsigned 64-bit values are DECIMAL(20,0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE_TYPES = ("float64", "int64", "uint64", "bool", "string")
VALUE_COLUMNS = {"float64": "double", "int64": "long", "uint64": "decimal(20,0)", "bool": "boolean", "string": "string"}
_VALUES = ", ".join(f"value_{k} {v}" for k, v in VALUE_COLUMNS.items())

POINTS = f"measurement string, tags map<string,string>, time_ns long, field string, value_type string, {_VALUES}"
IDENTIFIED_POINTS = f"{POINTS}, series_id binary, vsn string, sensor string, instrument_id string, identity_source string"
FACTS = f"time_ns long, time timestamp, sensor string, vsn string, instrument_id string, measurement string, field string, series_id binary, value_type string, {_VALUES}"
SERIES = "series_id binary, sensor string, vsn string, instrument_id string, measurement string, identity_source string, tags map<string,string>, fields array<string>, value_types array<string>, minimum_time long, maximum_time long"
QUARANTINE = f"time_ns long, time timestamp, measurement string, field string, series_id binary, value_type string, {_VALUES}, tags map<string,string>"
FINDINGS = "variable string, check_id string, bit int, observed_value double, observed_value_string string, score double, run_id string, work_unit_id string"
CHECK_RESULTS = (
    "check_id string, variable string, flag_name string, bit int, engine string, processor string, units_tested long, units_passed long, "
    "units_failed long, fraction_failed double, warning boolean, error boolean, critical boolean, config_hash string"
)
QC_FLAGS = "variable string, qc_bits decimal(20,0), run_id string, work_unit_id string"


def typed_values(value_type: str | Column, value: str | Column) -> list[Column]:
    """One nullable column for each value type, from a type and a text that was checked before."""
    kind = F.col(value_type) if isinstance(value_type, str) else value_type
    text = F.col(value) if isinstance(value, str) else value
    return [F.when(kind == name, text.try_cast(sql)).alias(f"value_{name}") for name, sql in VALUE_COLUMNS.items()]


def filled(columns: list[str] | None = None) -> Column:
    """How many of the value columns a row fills; one, in every fact."""
    names = columns or [f"value_{k}" for k in VALUE_TYPES]
    total = F.lit(0)
    for name in names:
        total = total + F.col(name).isNotNull().cast("int")
    return total


def unsigned(mask: str | Column) -> Column:
    """A 64-bit pattern held in a long as the unsigned number that it means."""
    bits = F.col(mask) if isinstance(mask, str) else mask
    wide = bits.cast("decimal(20,0)")
    return F.when(bits < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def bit(number: str | Column) -> Column:
    """A mask with one bit (0 to 63) set."""
    at = F.col(number) if isinstance(number, str) else number
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def exactly_one_value(facts: DataFrame) -> DataFrame:
    """Rows that break the rule that one value column is filled."""
    return facts.filter(filled() != 1)
