"""Shared plumbing of the training-data operators: tables, scratch space, words."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators between words: space and the controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch; texts can be long, so batches stay small.
BATCH_ROWS = 512
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column whose nulls count as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Few rows at a time, from the scan to Python: a batch of long texts is held several times over."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(2 * BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@functools.cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="tsforge-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = _own_root()
    return f"{root.rstrip('/')}/tsforge-llm-{spark.sparkContext.applicationId}"


@functools.cache
def _kept_until_exit(spark: SparkSession, root: str) -> str:
    """The application's folder, that goes when the driver's JVM does."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it again.

    This cuts the lineage: what follows survives the loss of any executor
    without running the stages before it again, and has real statistics. Tables
    go at the end of the application, or when ``discard`` is told so.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{_kept_until_exit(spark, scratch_root(spark))}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables written by this driver, in order.
_paths: list[str] = []


def tables_written() -> list[str]:
    return list(_paths)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _paths.remove(name)


#: Bytes, by the widths that the planner gives to types, up to which a table is sent to every task.
BROADCAST_BYTES = 24 << 20


def sent_if_small(df: DataFrame) -> DataFrame:
    """A narrow, written table (counting it reads no more than its footers) marked for broadcast if it is small; beyond that it is shuffled."""
    return F.broadcast(df) if df.count() * df._jdf.schema().defaultSize() <= BROADCAST_BYTES else df


#: Partitions up to which numbers are dealt exactly; beyond, chance levels them well enough.
EXACT = 8192


@functools.lru_cache(maxsize=8)
def _keys(n: int) -> tuple[int, ...]:
    """For each of ``n`` hash partitions the least integer that falls into it."""
    spark = SparkSession.getActiveSession()
    ids = spark.range(0, 40 * n, 1, 1).select(F.col("id").cast("int").alias("k"))
    found = ids.groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).collect()
    keys = {r.p: r.k for r in found}
    return tuple(keys.get(p, p) for p in range(n))


def deal_exactly(df: DataFrame, number: Column, n: int) -> DataFrame:
    """Rows dealt to the partition of their number (0 to n - 1), so that no two numbers share one.

    Hashing the numbers themselves would leave a third of the partitions empty.
    """
    if n > EXACT:
        return df.repartition(n, number)
    keys = F.array(*map(F.lit, _keys(n)))
    return df.repartition(n, F.element_at(keys, number.cast("int") + 1))
