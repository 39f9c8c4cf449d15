"""Half-open ranges: clipped to a range, expanded to days, compared with what is there; joined with each other, and their gaps.

``joined`` and ``gaps`` take ranges of numbers (nanoseconds, days) of any length and
never make a row for each day. Empty ranges, and those with a null end, touch nothing.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlapping(ranges: DataFrame, low: str, high: str, start: date | Column, end: date | Column) -> DataFrame:
    """Ranges [low, high) that touch [start, end), clipped to it."""
    first, past = F.greatest(F.col(low), F.lit(start)), F.least(F.col(high), F.lit(end))
    return ranges.withColumns({low: first, high: past}).filter(F.col(low) < F.col(high))


def expanded(ranges: DataFrame, low: str, high: str, name: str = "day") -> DataFrame:
    """A row for each day of a range; empty ranges have none."""
    days = F.when(F.col(low) < F.col(high), F.sequence(low, F.date_sub(high, 1)))
    return ranges.withColumn(name, F.explode(days))


def missing_days(wanted: DataFrame, there: DataFrame, name: str = "day") -> DataFrame:
    """Wanted days that nothing covers."""
    return wanted.join(there.select(name).distinct(), name, "left_anti")


def joined(left: DataFrame, right: DataFrame, width: int, on: list[str] = (), low: str = "low", high: str = "high") -> DataFrame:
    """Pairs of ranges that overlap, and agree in the columns ``on``: theirs and ours, with ``low`` and ``high`` of the overlap.

    A range is in each bin of ``width`` that it touches, and a pair counts in one of
    them: the bin where the later of the two begins. So a pair comes once, by an equal
    join; the width should be about as long as most ranges are. Other columns must
    have different names on both sides.
    """
    def binned(df: DataFrame, a: str, b: str) -> DataFrame:
        known = df.withColumnsRenamed({low: a, high: b}).filter(F.col(a) < F.col(b))
        return known.withColumn("_bin", F.explode(F.sequence(_bin(F.col(a), width), _bin(F.col(b) - 1, width))))

    pairs = binned(left, "_a0", "_a1").join(binned(right, "_b0", "_b1"), [*on, "_bin"])
    first, past = F.greatest("_a0", "_b0"), F.least("_a1", "_b1")
    met = pairs.filter((first < past) & (F.col("_bin") == _bin(first, width)))
    return met.withColumns({low: first, high: past}).drop("_bin", "_a0", "_a1", "_b0", "_b1")


def _bin(at: Column, width: int) -> Column:
    """Integer division that rounds down below zero as well."""
    return F.call_function("div", at - F.pmod(at, F.lit(width)), F.lit(width))


def gaps(ranges: DataFrame, width: int, by: list[str] = (), low: str = "low", high: str = "high") -> DataFrame:
    """Where, between the first and last of a key's ranges, none of them is: the key, low and high of each gap.

    Ranges are swept in bins of their beginnings: how far all bins before reach is
    one number for each bin, so no key's ranges meet in one task, be there ever so many.
    """
    known = ranges.filter(F.col(low) < F.col(high)).select(*by, F.col(low).alias("_a"), F.col(high).alias("_b")).withColumn("_bin", _bin(F.col("_a"), width))
    tops = known.groupBy(*by, "_bin").agg(F.max("_b").alias("_top"))
    earlier = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    reach = tops.select(*(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), F.col("_bin").alias("_of"), F.max("_top").over(earlier).alias("_reach"))
    same = reduce(and_, [F.col("_bin") == F.col("_of"), *(F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by))])
    inside = Window.partitionBy(*by, "_bin").orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1)
    swept = known.join(reach, same).withColumn("_before", F.greatest("_reach", F.max("_b").over(inside)))
    return swept.filter("_a > _before").select(*by, F.col("_before").alias(low), F.col("_a").alias(high))
