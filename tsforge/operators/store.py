"""Stores: partitioned writes that appear at once, and what says that they are complete.

Spark's committer protects one write. A unit of several tables is staged beside
its place and renamed when all of it is there, through Hadoop's file systems, so
any store that Spark writes to will do.
"""

from __future__ import annotations

import functools
import json
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.functions import times

#: Rows in a file at most; codec of all Parquet files.
ROWS_PER_FILE = 500_000
#: Rows in a row group at most.
ROWS_PER_GROUP = 250_000
OPTIONS = {"compression": "zstd", "maxRecordsPerFile": str(ROWS_PER_FILE), "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": str(ROWS_PER_GROUP)}
FACT_KEYS = ("sensor", "vsn", "instrument", "date")


@functools.cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="tsforge-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path where driver and executors share it; a temporary one only on a local master that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = _own_root()
    return f"{_kept_until_exit(spark, f"{root.rstrip('/')}/tsforge-{spark.sparkContext.applicationId}")}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _kept_until_exit(spark: SparkSession, root: str) -> str:
    """The application's folder, that goes when the driver's JVM does."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return root


def kept(rows: DataFrame, name: str) -> DataFrame:
    """A small table written where executors share it, and read again; what follows doesn't work it out twice."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def mounted(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared one, for what is read and written by places in files; it must be mounted where executors run."""
    path = scratch(spark, name).removeprefix("file:")
    if "://" in path:
        raise ValueError("spark.checkpoint.dir must be mounted where executors run")
    Path(path).mkdir(parents=True, exist_ok=True)
    return path


#: Bytes, by the widths that the planner gives to types, up to which a table is sent to every task.
BROADCAST_BYTES = 24 << 20


def sent_if_small(df: DataFrame) -> DataFrame:
    """A narrow table, which is counted first, marked for broadcast if it is small; beyond that it is shuffled."""
    return F.broadcast(df) if df.count() * df._jdf.schema().defaultSize() <= BROADCAST_BYTES else df


class Files:
    """A few operations of Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._gateway = spark.sparkContext._gateway
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def rename(self, old: str, new: str) -> None:
        p, fs = self._at(old)
        target = self._at(new)[0]
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(p, target):
            raise FileExistsError(f"can't put {old} at {new}")

    def put(self, local: str, path: str, move: bool = False) -> None:
        """A file that the driver sees mounted, to any store; moved within one file system, it is renamed."""
        p, fs = self._at(path)
        fs.mkdirs(p.getParent())
        source, own = self._at(local if "://" in local else f"file://{local}")
        if not (move and own.getUri().equals(fs.getUri()) and fs.rename(source, p)):
            fs.copyFromLocalFile(move, source, p)

    def write_stream(self, path: str, source) -> None:
        """All that a binary stream gives, in pieces."""
        p, fs = self._at(path)
        out = fs.create(p, True)
        while block := source.read(1 << 20):
            out.write(bytearray(block))
        out.close()

    def read_text(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Through a temporary name, so readers see all of it or nothing."""
        p, fs = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(p, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        files = hadoop.FileContext.getFileContext(fs.makeQualified(p).toUri(), self._conf)
        files.rename(fs.makeQualified(p), fs.makeQualified(self._at(path)[0]), options)

    def create_new(self, path: str, text: str) -> None:
        """A whole file under a name that nobody has, or FileExistsError: of two writers at a time one succeeds.

        Local disks link the file to its name, other stores rename it, which fails if the name is there.
        """
        p, fs = self._at(path)
        part = f"{path}.{uuid.uuid4().hex}.tmp"
        q = self._at(part)[0]
        fs.mkdirs(p.getParent())
        stream = fs.create(q, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if fs.getUri().getScheme() == "file":
                os.link(fs.makeQualified(q).toUri().getPath(), fs.makeQualified(p).toUri().getPath())
            else:
                none = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), self._conf).rename(fs.makeQualified(q), fs.makeQualified(p), none)
        except Exception as e:
            if self.exists(path):
                raise FileExistsError(path) from e
            raise
        finally:
            fs.delete(q, False)

    def names(self, path: str) -> list[str]:
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def partition_path(spark: SparkSession, root: str, values: dict[str, str]) -> str:
    """The folder of a partition of facts, with names escaped as Spark's writer does."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([f"{root}/facts", *(f"{k}={escape(values[k])}" for k in FACT_KEYS)])


def write_facts(facts: DataFrame, root: str) -> None:
    """Facts under sensor=/vsn=/instrument=/date=, the instrument_id in the files as well.

    What a partition held is replaced, so a write that was cut short can be
    repeated. Rows are rebalanced by the partition's key: adaptive execution splits
    what is too much for a task, be it of a single dense series, and joins what is
    too little, so that small partitions are one file.
    """
    rows = facts.withColumns({"instrument": F.col("instrument_id"), "date": F.date_format(times.date_of(F.col("time_ns")), "yyyy-MM-dd")})
    dealt = rows.hint("rebalance", *map(F.col, FACT_KEYS))
    _replace(dealt.sortWithinPartitions(*FACT_KEYS, "measurement", "field"), f"{root}/facts", *FACT_KEYS)


def _replace(rows: DataFrame, path: str, *by: str) -> None:
    """Write partitions in place of what they hold; others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**OPTIONS).partitionBy(*by).parquet(path)


def write_quarantine(rows: DataFrame, root: str, run_id: str) -> None:
    _replace(rows.withColumn("run", F.lit(run_id)), f"{root}/_quarantine", "run", "reason", "date")


def write_series(series: DataFrame, root: str, run_id: str) -> None:
    series.orderBy("series_id").write.mode("overwrite").options(**OPTIONS).parquet(f"{root}/_series/run={run_id}")


def write_csv(table: DataFrame, path: str, *order: str) -> None:
    """A catalog as one sorted CSV with a header: catalogs are small, a row for each variable or series."""
    table.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_lines(table: DataFrame, path: str) -> None:
    """The distinct values of a one-column table, sorted, one on each line."""
    (name,) = table.columns
    table.distinct().orderBy(name).coalesce(1).write.mode("overwrite").text(path)


def unfinished(rows: DataFrame, done: DataFrame, identity: dict[str, str], policy: str = "error") -> DataFrame:
    """Rows of partitions that are not complete yet.

    ``done`` has a row for each complete partition: the fact keys and the columns
    of ``identity``. A partition made otherwise is an error; one that was made
    alike is one as well, unless the policy is "skip".
    """
    if policy not in ("error", "skip"):
        raise ValueError("the policy is error or skip")
    other = F.lit(False)
    for k, v in identity.items():
        other = other | ~F.col(k).eqNullSafe(F.lit(v))
    keys = [c for c in FACT_KEYS if c in done.columns]
    met = done.join(rows.select(*keys).distinct(), keys, "left_semi")
    if met.filter(other).take(1):
        raise ValueError("a partition was made from other inputs or rules")
    if policy == "error" and met.take(1):
        raise FileExistsError("a partition exists already")
    return rows.join(done.select(*keys), keys, "left_anti")


def guard_identity(spark: SparkSession, root: str, identity: dict) -> None:
    """The dataset at ``root`` is new, or was made with the same identity."""
    files, path = Files(spark), f"{root}/_dataset.json"
    if files.exists(path):
        if json.loads(files.read_text(path)) != identity:
            raise ValueError(f"{root} was made with another identity")
    else:
        files.write_text(path, json.dumps(identity, sort_keys=True, indent=1))


class Staged:
    """A unit of several tables: staged, then renamed to its place with its marker inside.

    If the work inside fails, what was staged stays for a look at it.
    """

    def __init__(self, spark: SparkSession, place: str):
        self.files, self.place = Files(spark), place
        self.path = f"{place.rsplit('/', 1)[0]}/_staging/{place.rsplit('/', 1)[1]}-{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame) -> None:
        df.write.options(**OPTIONS).parquet(f"{self.path}/{name}")

    def publish(self, marker: dict) -> None:
        self.files.write_text(f"{self.path}/success.json", json.dumps(marker, sort_keys=True, indent=1))
        self.files.rename(self.path, self.place)
