"""Which files may hold a range of times or a series: zone maps and Bloom filters, read before any file is listed.

A row for each file has its rows, its least and greatest time, and a Bloom filter
of its series (``BITS`` bits, ``HASHES`` of them for each). The index is written beside the
facts and brought up to date by the files that it does not know; those that are
gone from the facts are left out when it is asked. A filter may say that a file
holds a series which it does not, never the other way; so what is read is filtered
once more. Files whose times or series are null are always read.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.operators.store import Files

#: Bits of a filter (of 4 KB), and hashes of a series: with 2,000 series in a file, one answer in 400 is a false yes.
BITS, HASHES = 1 << 15, 4


def _places(series: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(series, F.lit(i)), F.lit(BITS)) for i in range(HASHES)]


def described(facts: DataFrame, file: Column) -> DataFrame:
    """A row for each file: file, rows, low, high, unknown (rows without time or series), filter. One exchange of series by file, one of filters."""
    seen = facts.select(file.alias("file"), "time_ns", "series_id")
    unknown = (F.col("time_ns").isNull() | F.col("series_id").isNull()).cast("long")
    by_series = seen.groupBy("file", "series_id").agg(F.count("*").alias("rows"), F.min("time_ns").alias("low"), F.max("time_ns").alias("high"), F.sum(unknown).alias("unknown"))
    bits = by_series.withColumn("place", F.explode(F.when(F.col("series_id").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.array(*_places(F.col("series_id"))))))
    spread = by_series.groupBy("file").agg(F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("unknown").alias("unknown"))
    return spread.join(bits.groupBy("file").agg(F.bitmap_construct_agg("place").alias("filter")), "file")


def update(spark: SparkSession, facts: str, index: str) -> int:
    """Describes the files of a dataset that its index does not know; how many they were."""
    there = _listed(spark, facts)
    known = spark.read.parquet(index).select("file") if Files(spark).exists(index) else None
    new = [r.file for r in (there if known is None else there.join(known, "file", "left_anti")).collect()]
    if new:
        rows = spark.read.option("basePath", facts).parquet(*new)
        described(rows, F.col("_metadata.file_path")).write.mode("append").parquet(index)
    return len(new)


def _listed(spark: SparkSession, facts: str) -> DataFrame:
    """The files of a dataset, from its listing alone."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(facts).select(F.col("_metadata.file_path").alias("file"))


def _may_hold(series: bytes) -> Column:
    byte = lambda p: F.conv(F.hex(F.col("filter").substr((F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = lambda p: F.call_function("shiftright", byte(p), (p % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return reduce(and_, [bit(p) for p in _places(F.lit(bytearray(series)))])


def candidates(spark: SparkSession, index: str, low: int | None = None, high: int | None = None, series: list[bytes] | None = None) -> DataFrame:
    """The files that may hold times of [low, high) and any of the series."""
    wanted = F.lit(True)
    if low is not None:
        wanted = wanted & (F.col("high") >= low)
    if high is not None:
        wanted = wanted & (F.col("low") < high)
    if series is not None:
        wanted = wanted & (reduce(or_, [_may_hold(s) for s in series]) if series else F.lit(False))
    return spark.read.parquet(index).filter((F.col("unknown") > 0) | wanted).select("file")


def read(spark: SparkSession, facts: str, index: str, low: int | None = None, high: int | None = None, series: list[bytes] | None = None) -> DataFrame | None:
    """The facts of [low, high) and of the series, from the files that may hold them; none if there are none."""
    held = candidates(spark, index, low, high, series).join(_listed(spark, facts), "file", "left_semi")
    paths = sorted(r.file for r in held.collect())
    if not paths:
        return None
    rows = spark.read.option("basePath", facts).parquet(*paths)
    exact = [F.col("time_ns") >= low] * (low is not None) + [F.col("time_ns") < high] * (high is not None)
    if series is not None:
        exact.append(F.col("series_id").isin([bytearray(s) for s in series]))
    return rows.filter(reduce(and_, exact)) if exact else rows
