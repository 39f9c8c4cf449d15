"""Fact tables, index dumps and backup manifests."""

from __future__ import annotations

import hashlib
import json
import re
import shutil
import tarfile
from contextlib import contextmanager
from datetime import date, datetime
from pathlib import Path, PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from tsforge.functions import times
from tsforge.functions.identity import retained
from tsforge.sources.line_protocol import parse_series


def read_facts(spark: SparkSession, path: str, hive: bool = True, union_by_name: bool = True) -> DataFrame:
    """A Parquet dataset with ``_source_file``; nanosecond times come as longs, partitions as text."""
    base = re.split(r"/[^/]*[*?\[]", path)[0]
    reader = spark.read.option("mergeSchema", str(union_by_name).lower())
    if base != path:
        reader = reader.option("recursiveFileLookup", str(not hive).lower()).option("pathGlobFilter", "*.parquet")
        reader = reader.option("basePath", base) if hive else reader
    # no option of a reader, and asked for again when a job starts; without it Spark refuses nanosecond times
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    with settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        found = reader.parquet(base)
    return found.withColumn("_source_file", F.col("_metadata.file_path"))


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Settings of the session, put back as they were at the end."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def source_files(facts: DataFrame) -> DataFrame:
    """Path, size and time of each file that holds rows: what an input's fingerprint is made of."""
    return facts.select("_metadata.file_path", "_metadata.file_size", F.unix_micros("_metadata.file_modification_time").alias("modified_us")).distinct().orderBy("file_path")


INDEX_ROW = r"^\s*\d+\t(\S+Z)\t(\S+Z)\t(\d+)\t(\d+)\t([^\t]*)\t(.*)$"
#: The same for Python, with the ends of lines that Spark's expressions know; and a time.
_ENDS = "\n\r\x85\u2028\u2029"
_ROW = re.compile(INDEX_ROW.replace("(.*)$", rf"([^{_ENDS}]*)(?:\r\n|[{_ENDS}])?\Z"), re.A)
_TIME = re.compile(r"(\d{4}-\d{2}-\d{2})T(\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,9}))?Z", re.A)
#: Series and days that a task keeps.
_KEPT = 100_000
_INDEX_COLUMNS = pa.schema(
    [("_line", pa.string()), ("fits", pa.bool_()), ("series_key", pa.string()), ("measurement", pa.string()), ("tags", pa.map_(pa.string(), pa.string())), ("field", pa.string())]
    + [("minimum_time", pa.int64()), ("maximum_time", pa.int64())]
)


class _IndexLines:
    """Lines of a dump to their parts; each series and day is worked out once while it is kept."""

    def __init__(self):
        self.series: dict[str, tuple] = {}
        self.days: dict[str, int] = {}

    def _time(self, text: str) -> int:
        m = _TIME.fullmatch(text)
        if not m:
            raise ValueError(text)
        if (day := self.days.get(m[1])) is None:
            if len(self.days) >= _KEPT:
                self.days.clear()
            day = self.days[m[1]] = (date.fromisoformat(m[1]) - date(1970, 1, 1)).days * 86_400
        found = (day + int(m[2]) * 3600 + int(m[3]) * 60 + int(m[4])) * times.SECOND + int((m[5] or "").ljust(9, "0"))
        if not -(1 << 63) <= found < 1 << 63:
            raise ValueError(text)
        return found

    def _named(self, key: str) -> tuple:
        if (found := self.series.get(key)) is None:
            if len(self.series) >= _KEPT:
                self.series.clear()
            measurement, tags = parse_series(key)
            found = self.series[key] = (key, measurement, list(tags.items()))
        return found

    def row(self, line: str) -> tuple:
        """Whether it is an index row, series key, measurement, tags, field and times."""
        m = _ROW.match(line)
        try:
            return (True, *self._named(m[5]), m[6], self._time(m[1]), self._time(m[2])) if m else (False, *[None] * 6)
        except ValueError:
            return False, *[None] * 6


def _parts_of(column: str, more: tuple[str, ...]):
    def run(batches):
        parser = _IndexLines()
        for batch in batches:
            lines = batch.column(column)
            columns = zip(*map(parser.row, lines.to_pylist())) if batch.num_rows else [()] * 7
            made = [pa.array(c, f.type) for c, f in zip(columns, list(_INDEX_COLUMNS)[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in more), lines, *made], names=[*more, *_INDEX_COLUMNS.names])

    return run


def index_rows(lines: DataFrame, column: str = "value", *more: str) -> DataFrame:
    """Index rows with ``fits``: whether a line that begins with a number and a tab is one, with times and a series key that can be read.

    A line is taken apart once. As expressions its parts would be put into all that is made of them, each with the regular expression again.
    """
    schema = lines.select(*more).schema
    for name, kind in (("_line", "string"), ("fits", "boolean"), ("series_key", "string"), ("measurement", "string"), ("tags", "map<string,string>"), ("field", "string"), ("minimum_time", "long"), ("maximum_time", "long")):
        schema = schema.add(name, kind if "<" not in kind else MapType(StringType(), StringType()))
    return lines.filter(F.col(column).rlike(r"^\s*\d+\t")).select(*more, column).mapInArrow(_parts_of(column, more), schema)


def with_tags(rows: DataFrame) -> DataFrame:
    """Index rows that fit, with measurement and the tags that are part of a series."""
    return rows.withColumn("tags", retained(F.col("tags"))).drop("series_key", "fits", "_line")


def parse_index(lines: DataFrame, column: str = "value") -> DataFrame:
    """Index rows of a storage dump: measurement, tags, field and times of each block.

    Lines that don't begin with a number and a tab are left out; others that
    don't fit are errors.
    """
    rows = index_rows(lines, column)
    checked = F.when(F.col("fits"), F.col("measurement")).otherwise(F.raise_error(F.concat(F.lit("not an index row: "), F.col("_line"))).cast("string"))
    return with_tags(rows.withColumn("measurement", checked)).select("measurement", "tags", "field", "minimum_time", "maximum_time")


def load_backup(directory: str, bucket_id: str) -> dict:
    """A bucket's shards, by start and id, from the one manifest of a backup directory."""
    found = [p for p in sorted(Path(directory).glob("*.manifest")) if not p.name.startswith("._")]
    if len(found) != 1:
        raise ValueError(f"expected one manifest in {directory}, found {len(found)}")
    buckets = [b for b in json.loads(found[0].read_text()).get("buckets", []) if b.get("bucketID") == bucket_id]
    if len(buckets) != 1:
        raise ValueError(f"expected the bucket {bucket_id} once, found it {len(buckets)} times")
    shards = []
    for policy in buckets[0].get("retentionPolicies", []):
        for group in policy.get("shardGroups", []):
            for shard in group.get("shards", []):
                path = Path(directory) / shard["fileName"]
                if not path.is_file():
                    raise ValueError(f"no archive {path}")
                start, end = (datetime.fromisoformat(group[k].replace("Z", "+00:00")) for k in ("startTime", "endTime"))
                shards.append({"id": int(shard["id"]), "path": str(path), "size": int(shard["size"]), "start": start, "end": end})
    snapshot = f"{found[0].name.removesuffix('.manifest')}:{hashlib.sha256(found[0].read_bytes()).hexdigest()}"
    return {"bucket_id": bucket_id, "name": buckets[0].get("bucketName"), "snapshot": snapshot, "shards": sorted(shards, key=lambda s: (s["start"], s["id"]))}


#: What is read of a manifest; numbers as their text, so that one that does not fit is an error.
_MANIFEST = "buckets array<struct<bucketID:string,retentionPolicies:array<struct<shardGroups:array<struct<startTime:string,endTime:string,shards:array<struct<id:string,fileName:string,size:string>>>>>>>>"


def backup_shards(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The shards of all buckets of manifests on any store: bucket_id, shard_id, file, size, start, end.

    A manifest is a file, or (``lines``) a line of files that hold many. One that is no JSON is an error.
    """
    buckets = spark.read.schema(_MANIFEST).option("multiLine", str(not lines).lower()).option("mode", "FAILFAST").json(path).select(F.explode("buckets").alias("b"))
    groups = buckets.select(F.col("b.bucketID").alias("bucket_id"), F.explode("b.retentionPolicies").alias("p")).select("bucket_id", F.explode("p.shardGroups").alias("g"))
    return groups.select("bucket_id", "g.startTime", "g.endTime", F.explode("g.shards").alias("s")).select("bucket_id", F.col("s.id").cast("long").alias("shard_id"), F.col("s.fileName").alias("file"), F.col("s.size").cast("long").alias("size"), F.col("startTime").alias("start"), F.col("endTime").alias("end"))


def staged_members(names: list[tuple[str, int]], prefix: str, archive_size: int) -> list[str]:
    """The storage files to take from an archive's (name, size) list; unsafe paths are errors."""
    chosen: list[str] = []
    for name, _ in names:
        path = PurePosixPath(name)
        if path.is_absolute() or ".." in path.parts:
            raise ValueError(f"unsafe path in archive: {name}")
        if path.suffix != ".tsm" or not str(path).startswith(prefix):
            continue
        if name in chosen:
            raise ValueError(f"a file comes twice: {name}")
        chosen.append(name)
    if not chosen and archive_size > 32:
        raise ValueError("an archive without storage files")
    return chosen


def stage_archive(archive: str, target: str, prefix: str = "") -> list[str]:
    """Takes an archive's storage files out of it, streaming; the paths that were written.

    Members are read once and in order, so the archive is never held or seeked.
    """
    names: list[tuple[str, int]] = []
    written: list[str] = []
    with tarfile.open(archive, "r|*") as members:
        for member in members:
            names.append((member.name, member.size))
            if not staged_members(names[-1:], prefix, 0) or not member.isfile():
                continue
            path = Path(target) / PurePosixPath(member.name)
            if path.exists():
                raise ValueError(f"a file comes twice: {member.name}")
            path.parent.mkdir(parents=True, exist_ok=True)
            with members.extractfile(member) as source, open(path, "wb") as out:
                shutil.copyfileobj(source, out, 1 << 20)
            written.append(str(path))
    staged_members(names, prefix, Path(archive).stat().st_size)
    return written


def read_list(path: str) -> set[str]:
    """Ids of an allow-list: one on each line, comments after ``#``."""
    lines = (line.split("#", 1)[0].strip() for line in Path(path).read_text().splitlines())
    return {line for line in lines if line}


def parse_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """The ids of an allow-list as a table (instrument_id), of lines like those of ``read_list``."""
    found = F.trim(F.substring_index(column, "#", 1)).alias("instrument_id")
    return lines.select(found).filter("instrument_id <> ''").distinct()


def export_command(binary: str, engine: str, bucket_id: str, measurements: list[str], start: datetime, end: datetime, output: str = "-") -> list[str]:
    """The command that would export a range of a storage engine as line protocol."""
    command = [binary, "inspect", "export-lp", "--engine-path", engine, "--bucket-id", bucket_id, "--output-path", output]
    for name in sorted(set(measurements)):
        command += ["--measurement", name]
    moment = lambda x: times.as_utc(x).strftime("%Y-%m-%dT%H:%M:%SZ")
    return [*command, "--start", moment(start), "--end", moment(end)]
