"""Level-1 tables and files: observations with their masks, codes and coverage; a file for each day, all days of a run as one job."""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsforge.functions import times
from tsforge.functions.times import DAY, SECOND, Period
from tsforge.plans.qc_config import Profile, Rules
from tsforge.sources import cdf


def variable_codes(profile: Profile) -> dict[str, int]:
    return {v.name: i for i, v in enumerate(profile.variables)}


def with_codes(observations: DataFrame, codes: dict[str, int]) -> DataFrame:
    """Adds ``variable_code``; a variable without one is an error."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    code = F.try_element_at(table, F.col("variable"))
    return observations.withColumn("variable_code", F.coalesce(code, F.raise_error(F.concat(F.lit("no code for "), F.col("variable"))).cast("int")))


def coverage(observations: DataFrame, *by: str) -> DataFrame:
    """First and last second (exclusive) that observations touch, and the duration."""
    second = lambda c: times.floor_div(c, SECOND)
    spans = observations.groupBy(*by).agg(second(F.min("time_ns")).alias("first_second"), (second(F.max("time_ns")) + 1).alias("end_second"))
    return spans.withColumn("duration", duration_text(F.col("end_second") - F.col("first_second")))


def duration_text(seconds: Column) -> Column:
    return F.concat(F.lit("PT"), F.coalesce(seconds, F.lit(0)).cast("string"), F.lit("S"))


def attributes(rules: Rules, profile: Profile, period: Period, span: tuple[int, int] | None) -> dict[str, str]:
    """A file's global attributes; ``span`` is the first and last second, or None if it is empty."""
    text = lambda ns: times.boundary_text(period.start) if ns is None else ns
    first, end = span or (None, None)
    moment = lambda s: period.start.strftime("%Y-%m-%dT%H:%M:%SZ") if s is None else _iso(s)
    by_bit = sorted(rules.flags.items(), key=lambda x: x[1])
    return {
        "time_coverage_start": moment(first), "time_coverage_end": moment(end), "time_coverage_duration": times.iso_duration((end - first) * SECOND) if span else "PT0S",
        "time_coverage_resolution": "variable-dependent native sampling" if span else "not_applicable", "flag_meanings": " ".join(n for n, _ in by_bit), "flag_masks": " ".join(str(1 << b) for _, b in by_bit),
        "variables": ",".join(variable_codes(profile)), "period": text(None),
    }


def _iso(second: int) -> str:
    from datetime import UTC, datetime, timedelta

    return (datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")


def file_name(site: str, name: str, vsn: str, period: Period) -> str:
    if (period.bounds[1] - period.bounds[0]) != DAY or period.bounds[0] % DAY:
        raise ValueError("a level-1 file holds one UTC day")
    stamp = lambda t: t.strftime("%Y%m%dT%H%M%SZ")
    return f"{site}.{name}.{vsn}.native.a1.{stamp(period.start)}-{stamp(period.end)}.nc"


_FLAG_NAME = re.compile(r"[A-Za-z0-9_]+")


def file_variables(rules: Rules, profile: Profile, keys: dict[str, str]) -> list[cdf.Variable]:
    """The variables of a file; ``keys`` are the observation keys with their types: times as numbers, 16-byte ids as bytes, others as texts."""
    if bad := [name for name in rules.flags if not _FLAG_NAME.fullmatch(name)]:
        raise ValueError(f"flags of a file are named by letters, digits and underscores: {bad}")
    table = {str(i): {"name": v.name, **{k: dict(v.where).get(k, "") for k in ("measurement", "field")}, "units": v.units or "1", "data_type": "string" if v.is_string else "numeric"} for i, v in enumerate(profile.variables)}
    by_bit = sorted(rules.flags.items(), key=lambda x: x[1])
    out = [cdf.Variable("time_ns", "i8", {"long_name": "observation time", "standard_name": "time", "units": "nanoseconds since 1970-01-01 00:00:00 UTC", "calendar": "proleptic_gregorian"})]
    for key, kind in keys.items():
        if key != "time_ns":
            said = {"long_name": f"observation key: {key}"}
            out.append(cdf.Variable(key, "u1", said, 16) if kind == "binary" else cdf.Variable(key, "text", said))
    return [
        *out,
        cdf.Variable("variable", "u2", {"long_name": "variable code", "code_table": json.dumps(table, sort_keys=True, separators=(",", ":")), "flag_values": np.arange(len(table), dtype=np.uint16), "flag_meanings": " ".join(variable_codes(profile))}),
        cdf.Variable("observed_value", "f8", {"long_name": "numeric observation after quality control", "coordinates": "time_ns", "_FillValue": np.float64("nan")}),
        cdf.Variable("observed_value_string", "text", {"long_name": "string observation after quality control", "coordinates": "time_ns", "missing_value": ""}),
        cdf.Variable("qc_bits", "u8", {"long_name": "quality mask; zero means that no check failed", "coordinates": "time_ns", "flag_masks": np.array([1 << b for _, b in by_bit], np.uint64), "flag_meanings": " ".join(n for n, _ in by_bit)}),
    ]


def write_files(flagged: DataFrame, by: str, rules: Rules, profile: Profile, keys: tuple[str, ...], paths: dict[str, str], said: dict[str, dict]) -> dict[str, int]:
    """A file for each value of ``by`` (texts) that ``paths`` names, in the order of variable, time and other keys; how many rows each holds.

    The folder is one that executors share. Rows never pass the driver.
    """
    kinds = dict(flagged.dtypes)
    coded = with_codes(flagged, variable_codes(profile)).drop("variable").withColumnRenamed("variable_code", "variable")
    texts = {k: F.col(k).cast("string") for k in keys if k != "time_ns" and kinds[k] not in ("binary", "string")}
    order = ["variable", "time_ns", *(k for k in keys if k != "time_ns")]
    return cdf.write(coded.withColumns(texts) if texts else coded, by, order, file_variables(rules, profile, {k: kinds[k] for k in keys}), paths, said)
