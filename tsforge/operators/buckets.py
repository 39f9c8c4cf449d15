"""Tables bucketed and sorted by their keys, so that joins on these move nothing.

Facts and what is found about them share their keys; written with the same buckets,
their join reads bucket with bucket. A table written again with the same keys and
number keeps that layout. Files are one for each bucket, sorted, so a join by
merging needs no sort either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tsforge.operators.store import OPTIONS

#: Bytes of a bucket that a task can sort in memory; what ``buckets_for`` aims at.
BUCKET_BYTES = 128 << 20


def buckets_for(size: int) -> int:
    """A power of two, so that tables of different numbers still divide each other."""
    return 1 << max(0, (size // BUCKET_BYTES).bit_length())


@dataclass(frozen=True)
class Layout:
    """How tables that are joined lie: all keys of their join, and the number of buckets."""

    keys: tuple[str, ...]
    buckets: int

    def write(self, rows: DataFrame, name: str, path: str) -> DataFrame:
        """A table at a path, in place of what it held."""
        # dealt as the buckets are, so each is one task's and one file
        dealt = rows.repartition(self.buckets, *self.keys)
        options = {k: v for k, v in OPTIONS.items() if k != "maxRecordsPerFile"}
        dealt.write.mode("overwrite").options(**options, path=path).bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        return self.read(rows.sparkSession, name)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(name)
