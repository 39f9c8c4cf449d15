"""Quality control: observations, checks, findings, masks, reports.

All checks of a profile are evaluated in one pass: a row gets its variable by
one CASE, each check is a boolean, findings are the failed ones exploded, and
check results are conditional sums, so no row is multiplied before it fails.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsforge.plans.qc_config import Check, Profile, Rules, Variable
from tsforge.schema import bit, unsigned

ENGINE, PROCESSOR = "spark", "native"


def is_variable(v: Variable) -> Column:
    return reduce(and_, [F.col(k) == F.lit(x) for k, x in v.where])


def select(facts: DataFrame, profile: Profile, start_ns: int | None = None, end_ns: int | None = None, filters: tuple[tuple[str, str], ...] = (), time: str = "time_ns") -> DataFrame:
    """Rows of the period, the work unit and the profile's variables: one predicate that the scan gets."""
    wanted = reduce(or_, [is_variable(v) for v in profile.variables], F.lit(False)) if profile.variables else F.lit(False)
    for k, x in filters:
        wanted = wanted & (F.col(k) == F.lit(x))
    if start_ns is not None:
        wanted = wanted & (F.col(time) >= start_ns)
    if end_ns is not None:
        wanted = wanted & (F.col(time) < end_ns)
    return facts.filter(wanted)


def number_or_null(value: Column, missing: tuple[float, ...] = ()) -> Column:
    v = value.cast("double")
    return F.when(~(F.isnan(v) | (v.isin(list(missing)) if missing else F.lit(False))), v)


def text_or_null(value: Column, missing: tuple[str, ...] = ()) -> Column:
    return F.when(~value.isin(list(missing)), value) if missing else value


def normalize(facts: DataFrame, profile: Profile, keys: tuple[str, ...], *more: str) -> DataFrame:
    """Keys, variable, observed_value and observed_value_string; missing markers and NaN become null."""
    name, number, text = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("string")
    for v in reversed(profile.variables):
        mine = is_variable(v)
        name = F.when(mine, F.lit(v.name)).otherwise(name)
        if v.is_string:
            text = F.when(mine, text_or_null(F.col(v.column), v.missing_strings)).otherwise(text)
        else:
            number = F.when(mine, number_or_null(F.col(v.column), v.missing_values)).otherwise(number)
    return facts.select(*keys, *more, name.alias("variable"), number.alias("observed_value"), text.alias("observed_value_string"))


def fails(v: Variable, c: Check) -> Column:
    """Whether a row of the variable fails; ranges never fail a null."""
    if c.method == "col_vals_not_null":
        return F.col("observed_value_string" if v.is_string else "observed_value").isNull()
    x = F.col("observed_value")
    low = x >= c.left if c.inclusive[0] else x > c.left
    high = x <= c.right if c.inclusive[1] else x < c.right
    return F.coalesce(~(low & high), F.lit(False))


def findings(observations: DataFrame, profile: Profile, rules: Rules, run_id: str = "", work_unit_id: str = "") -> DataFrame:
    """A row for each failed check of an observation."""
    found = [
        F.when((F.col("variable") == v.name) & fails(v, c), F.struct(F.lit(c.id).alias("check_id"), F.lit(rules.flags[c.flag]).alias("bit")))
        for v, c in profile.checks()
    ]
    keys = [c for c in observations.columns if c not in ("variable", "observed_value", "observed_value_string")]
    none = F.array().cast("array<struct<check_id:string,bit:int>>")
    failed = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else none
    rows = observations.withColumn("_f", F.explode(failed))
    return rows.select(*keys, "variable", F.col("_f.check_id").alias("check_id"), F.col("_f.bit").alias("bit"), "observed_value", "observed_value_string", F.lit(None).cast("double").alias("score"), F.lit(run_id).alias("run_id"), F.lit(work_unit_id).alias("work_unit_id"))


def check_results(observations: DataFrame, profile: Profile, rules: Rules, *by: str, config_hash: str = "") -> DataFrame:
    """Units tested, passed and failed of each check, also of those that no row was for."""
    checks = profile.checks()
    sums = []
    for i, (v, c) in enumerate(checks):
        mine = F.col("variable") == v.name
        sums += [F.coalesce(F.sum(mine.cast("long")), F.lit(0)).alias(f"_t{i}"), F.coalesce(F.sum((mine & fails(v, c)).cast("long")), F.lit(0)).alias(f"_f{i}")]
    totals = observations.groupBy(*by).agg(*sums)
    level = lambda i, share: (F.lit(False) if share is None else (F.col(f"_t{i}") > 0) & (_ratio(F.col(f"_f{i}"), F.col(f"_t{i}")) >= share))
    rows = [
        F.struct(
            F.lit(c.id).alias("check_id"), F.lit(v.name).alias("variable"), F.lit(c.flag).alias("flag_name"), F.lit(rules.flags[c.flag]).alias("bit"), F.lit(ENGINE).alias("engine"), F.lit(PROCESSOR).alias("processor"),
            F.col(f"_t{i}").alias("units_tested"), (F.col(f"_t{i}") - F.col(f"_f{i}")).alias("units_passed"), F.col(f"_f{i}").alias("units_failed"), _ratio(F.col(f"_f{i}"), F.col(f"_t{i}")).alias("fraction_failed"),
            level(i, c.warning).alias("warning"), level(i, c.error).alias("error"), level(i, c.critical).alias("critical"), F.lit(config_hash).alias("config_hash"),
        )
        for i, (v, c) in enumerate(checks)
    ]
    return totals.select(*by, F.inline(F.array(*rows)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def compile_masks(found: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The bits of each observation's findings, OR-ed; ``mask`` is a pattern, ``qc_bits`` the number."""
    masks = found.groupBy(*keys, "variable").agg(F.bit_or(bit("bit")).alias("mask"), F.min("run_id").alias("run_id"), F.min("work_unit_id").alias("work_unit_id"))
    return masks.withColumn("qc_bits", unsigned("mask"))


def attach_masks(observations: DataFrame, masks: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Observations with ``mask`` and ``qc_bits``, zero where nothing was found; null keys match nothing."""
    joined = observations.join(masks.select(*keys, "variable", "mask"), [*keys, "variable"], "left")
    filled = joined.withColumn("mask", F.coalesce("mask", F.lit(0).cast("long")))
    return filled.withColumn("qc_bits", unsigned("mask"))


def flagged(observations: DataFrame, profile: Profile, rules: Rules, keys: tuple[str, ...]) -> DataFrame:
    """As ``attach_masks`` with the masks of ``findings``, where these are not stored: one exchange, and the input is read once.

    A row's own mask is an expression; rows of the same keys and variable share the OR of theirs.
    """
    own = F.lit(0).cast("long")
    for v, c in profile.checks():
        own = own.bitwiseOR(F.when((F.col("variable") == v.name) & fails(v, c), bit(F.lit(rules.flags[c.flag]))).otherwise(F.lit(0).cast("long")))
    known = reduce(and_, [F.col(k).isNotNull() for k in (*keys, "variable")])
    shared = F.bit_or(F.col("_own")).over(Window.partitionBy(*keys, "variable"))
    masked = observations.withColumn("_own", own).withColumn("mask", F.when(known, shared).otherwise(F.lit(0).cast("long"))).drop("_own")
    return masked.withColumn("qc_bits", unsigned("mask"))


def report(results: DataFrame) -> DataFrame:
    """Results of all periods summed, with the share of failed units."""
    total = lambda c: F.sum(c).alias(c)
    summed = results.groupBy("variable", "check_id", "flag_name", "bit").agg(*map(total, ("units_tested", "units_passed", "units_failed")))
    return summed.withColumn("fraction_failed", _ratio(F.col("units_failed"), F.col("units_tested"))).orderBy("variable", "bit", "check_id")


def validate_source(facts: DataFrame, profile: Profile, keys: tuple[str, ...], filters: tuple[tuple[str, str], ...] = ()) -> None:
    """Raises if columns are missing or of the wrong kind; runs no job."""
    kinds = dict(facts.dtypes)
    needed = {*keys, *(k for k, _ in filters), *(v.column for v in profile.variables), *(k for v in profile.variables for k, _ in v.where)}
    if missing := sorted(needed - set(kinds)):
        raise ValueError(f"the source lacks {missing}")
    for v in profile.variables:
        kind = kinds[v.column]
        if v.is_string != (kind == "string"):
            raise ValueError(f"the column {v.column} of {v.name} is {kind}")
        if not v.is_string and kind not in ("double", "float", "bigint", "int", "smallint", "tinyint") and not kind.startswith("decimal"):
            raise ValueError(f"the column {v.column} of {v.name} is {kind}")
