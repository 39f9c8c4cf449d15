"""Line protocol: ``measurement,tag=value field=value,... timestamp``.

Records end at newlines outside quoted strings, so a line-based reader can't
split them on its own. ``read_files`` reads any path that Spark can open, by
splits: lines whose quotes don't pair flip whether a split ends within a string,
so one aggregation tells which splits begin within one, and only records that
cross a split are put together again. The data source ``line_protocol`` streams
local or mounted files of any size, a partition each. Batches of Arrow columns
leave Python; every distinct series is parsed, and identified, once while it
stays in a bounded table.
"""

from __future__ import annotations

import glob
import gzip
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tsforge.functions.identity import Registry, python_identity
from tsforge.schema import IDENTIFIED_POINTS, POINTS, VALUE_TYPES

#: Points in an Arrow batch, and series that a worker keeps.
BATCH, KEPT = 20_000, 100_000
#: Bytes of made text that are one task's.
DEALT = 16 << 20

_SERIES = re.compile(r"(?:\\.|[^\\ ])*+\\?", re.S)
_FIELD = re.compile(r'((?:\\.|"(?:\\.|[^"\\])*+"|[^,"\\])++\\?)(?:,|\Z)', re.S)
_KEY = re.compile(r"(?:[^=]|(?<=\\)=)*+(?<!\\)=", re.S)
_TAG_PARTS = re.compile(r"(?:\\.|[^\\,])*+\\?", re.S)
_SKIPPED = re.compile(r"[ \t\x0b\f\r]*(?:#|\Z)")
_EQUALS = re.compile(r"((?:\\.|[^\\=])*+)=(.*)", re.S)
_RANGE = {"i": ("int64", -(1 << 63), (1 << 63) - 1), "u": ("uint64", 0, (1 << 64) - 1)}

SCHEMA = pa.schema(
    [("measurement", pa.string()), ("tags", pa.map_(pa.string(), pa.string())), ("time_ns", pa.int64()), ("field", pa.string()), ("value_type", pa.string())]
    + [("value_float64", pa.float64()), ("value_int64", pa.int64()), ("value_uint64", pa.decimal128(20, 0)), ("value_bool", pa.bool_()), ("value_string", pa.string())]
)

#: What a series' identity says, beside its measurement and tags.
IDENTITY = ("series_id", "vsn", "sensor", "instrument_id", "identity_source")
IDENTIFIED = pa.schema([*SCHEMA, *(pa.field(name, pa.binary() if name == "series_id" else pa.string()) for name in IDENTITY)])


class LineProtocolError(ValueError):
    """A record that is no line protocol."""


def _plain(text: str) -> str:
    """A backslash in an identifier takes itself away; one at the end stays."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def parse_series(text: str) -> tuple[str, dict[str, str]]:
    """A series key's measurement and tags."""
    parts, at = [], 0
    while at <= len(text):
        m = _TAG_PARTS.match(text, at)
        parts.append(m[0])
        at = m.end() + 1
    measurement = _plain(parts[0])
    if not measurement:
        raise LineProtocolError("a record without a measurement")
    tags: dict[str, str] = {}
    for part in parts[1:]:
        m = _EQUALS.fullmatch(part)
        if not m or not m[1] or not m[2]:
            raise LineProtocolError(f"not a tag: {part!r}")
        key = _plain(m[1])
        if key in tags:
            raise LineProtocolError(f"the tag {key!r} comes twice")
        tags[key] = _plain(m[2])
    return measurement, tags


def parse_value(text: str) -> tuple[str, object]:
    """A value's type and value, by its syntax."""
    if not text:
        raise LineProtocolError("a field without a value")
    if text[0] == '"':
        if len(text) < 2 or text[-1] != '"':
            raise LineProtocolError("a string that does not end")
        return "string", re.sub(r'\\(["\\])', r"\1", text[1:-1])
    if text in ("true", "false"):
        return "bool", text == "true"
    try:
        if text[-1] in _RANGE:
            kind, low, high = _RANGE[text[-1]]
            number = int(text[:-1])
            if not low <= number <= high:
                raise LineProtocolError(f"out of range: {text}")
            return kind, number
        return "float64", float(text)
    except LineProtocolError:
        raise
    except ValueError as e:
        raise LineProtocolError(f"not a value: {text!r}") from e


def parse_fields(text: str) -> list[tuple[str, str, object]]:
    """Names, types and values of a record's fields."""
    out, at = [], 0
    while at < len(text):
        m = _FIELD.match(text, at)
        key = m and _KEY.match(m[1])
        if not m or not key or len(key[0]) < 2:
            raise LineProtocolError(f"not a field: {text[at : at + 80]!r}")
        out.append((_plain(key[0][:-1]), *parse_value(m[1][key.end() :])))
        at = m.end()
        if at == len(text) and text[-1] == "," and m[0].endswith(","):
            raise LineProtocolError("a field is missing after a comma")
    if not out:
        raise LineProtocolError("a record without fields")
    return out


def parse_record(text: str) -> tuple[str, dict[str, str], int, list[tuple[str, str, object]]]:
    """Measurement, tags, time and fields."""
    series, rest = split_series(text)
    body, _, stamp = rest.rpartition(" ")
    try:
        return (*parse_series(series), int(stamp), parse_fields(body))
    except LineProtocolError:
        raise
    except ValueError as e:
        raise LineProtocolError(f"not a timestamp: {stamp!r}") from e


def split_series(text: str) -> tuple[str, str]:
    end = _SERIES.match(text).end()
    if end >= len(text):
        raise LineProtocolError("a record without fields")
    return text[:end], text[end + 1 :]


def _open_string(text: str) -> bool:
    """Whether a record's first part ends in a quoted string; quotes count from the first unescaped space."""
    end = _SERIES.match(text).end()
    return re.sub(r"\\.", "", text[end:], flags=re.S).count('"') % 2 == 1


def records(lines: Iterable[bytes]) -> Iterator[str]:
    """Logical records from lines with their newlines; comments and blank lines are left out."""
    held = ""
    for raw in lines:
        line = raw.decode("utf-8")
        line = line.removesuffix("\n").removesuffix("\r")
        if not held and _SKIPPED.match(line):
            continue
        held = f"{held}\n{line}" if held else line
        if '"' in held and _open_string(held):
            continue
        yield held
        held = ""
    if held:
        raise LineProtocolError("a string that does not end before the input does")


def parser_of(registry: Registry | None = None) -> Callable[[], _Columns]:
    """What makes a parser of points with identities, by the rules of a registry."""
    return lambda: _Columns(lambda measurement, tags: python_identity(measurement, tags, registry))


class _Columns:
    """Points gathered by column; what a series says is held once and taken by number."""

    def __init__(self, identify: Callable[[str, dict[str, str]], tuple] | None = None):
        self.identify = identify
        self.schema = SCHEMA if identify is None else IDENTIFIED
        self.numbers: dict[str, int] = {}
        self.known: list[tuple] = []
        self._clear()

    def _clear(self):
        self.series, self.times, self.names, self.kinds = [], [], [], []
        self.cells: dict[str, tuple[list, list]] = {k: ([], []) for k in VALUE_TYPES}
        if len(self.known) > KEPT:
            self.numbers.clear()
            self.known.clear()

    def __len__(self) -> int:
        return len(self.times)

    def add(self, record: str):
        key, rest = split_series(record) if "\\" in record else record.split(" ", 1) if " " in record else (record, "")
        number = self.numbers.get(key)
        if number is None:
            measurement, tags = parse_series(key)
            number = self.numbers[key] = len(self.known)
            named = () if self.identify is None else self.identify(measurement, tags)
            self.known.append((measurement, list(tags.items()), *named))
        body, _, stamp = rest.rpartition(" ")
        try:
            time_ns = int(stamp)
        except ValueError as e:
            raise LineProtocolError(f"not a timestamp: {stamp!r}") from e
        for name, kind, value in parse_fields(body) if '"' in body or "\\" in body else _plain_fields(body):
            places, values = self.cells[kind]
            places.append(len(self.times))
            values.append(value)
            self.series.append(number)
            self.times.append(time_ns)
            self.names.append(name)
            self.kinds.append(kind)

    def batch(self) -> pa.RecordBatch:
        n = len(self)
        numbers, at = np.unique(np.array(self.series, np.int64), return_inverse=True)
        taken, kinds = pa.array(at), {f.name: f.type for f in self.schema}
        said = list(zip(*(self.known[i] for i in numbers.tolist())))
        columns = {name: pa.array(values, kinds[name]).take(taken) for name, values in zip(("measurement", "tags", *IDENTITY), said)}
        columns |= {"time_ns": pa.array(self.times, pa.int64()), "field": pa.array(self.names), "value_type": pa.array(self.kinds)}
        for kind, (places, values) in self.cells.items():
            name = f"value_{kind}"
            if not values:
                columns[name] = pa.nulls(n, kinds[name])
                continue
            held = pa.array(values, pa.uint64()).cast(kinds[name]) if kind == "uint64" else pa.array(values, kinds[name])
            where = np.full(n, -1)
            where[places] = np.arange(len(places))
            columns[name] = held.take(pa.array(where, mask=where < 0))
        self._clear()
        return pa.RecordBatch.from_arrays([columns[f.name] for f in self.schema], schema=self.schema)


def _plain_fields(body: str):
    """The fields of a record without quotes and escapes."""
    for part in body.split(","):
        name, equals, text = part.partition("=")
        if not name or not equals:
            raise LineProtocolError(f"not a field: {part[:80]!r}")
        yield (name, *parse_value(text))


def batches_of(texts: Iterable[str], columns: _Columns | None = None) -> Iterator[pa.RecordBatch]:
    columns = _Columns() if columns is None else columns
    for text in texts:
        columns.add(text)
        if len(columns) >= BATCH:
            yield columns.batch()
    if len(columns):
        yield columns.batch()


def spread(df: DataFrame, column: str | None = None) -> DataFrame:
    """Rows of a plan without exchanges, dealt over the cluster if there are fewer partitions than cores: parsing a record costs more than moving it.

    Text that is made of packed columns may be many times their size. Its ``column`` is measured, and dealt by
    ``DEALT`` bytes, so that what a task parses (and sorts after that) doesn't grow with the input.
    """
    cores, have = df.sparkSession.sparkContext.defaultParallelism, df._jdf.rdd().getNumPartitions()
    size = df.agg(F.sum(F.octet_length(column))).first()[0] or 0 if column else 0
    wanted = max(cores, -(-size // DEALT))
    return df if have >= wanted else df.repartition(wanted)


def decode(df: DataFrame, column: str = "record", make: Callable[[], _Columns] = _Columns, schema: str = POINTS) -> DataFrame:
    """Points of a column of logical records."""

    def run(batches):
        columns = make()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is not None:
                    columns.add(text)
                    if len(columns) >= BATCH:
                        yield columns.batch()
            if len(columns):
                yield columns.batch()

    return df.select(column).mapInArrow(run, schema)


def decode_identified(df: DataFrame, column: str = "record", registry: Registry | None = None) -> DataFrame:
    """Points with series_id, vsn, sensor, instrument_id and identity_source, worked out where a series is first parsed."""
    return decode(df, column, parser_of(registry), IDENTIFIED_POINTS)


def _changes(text: Column) -> tuple[Column, Column]:
    """Whether a line that begins outside a string ends within one, and one that begins within a string outside."""
    bare = F.regexp_replace(text, r"\\.", "")
    every = F.regexp_count(bare, F.lit('"'))
    # outside, the quotes of a record's fields count; within, all do
    in_fields = every - F.regexp_count(F.substring_index(bare, " ", 1), F.lit('"'))
    return (in_fields % 2 == 1) & ~text.rlike(r"^[ \t\x0B\f\r]*#"), every % 2 == 1


def _crossing(lines: DataFrame) -> set[tuple[str, int]]:
    """The splits (file and offset) that begin within a string.

    A line changes whether one is in a string if its quotes don't pair; only such
    lines leave the JVM, and a split comes back as where it ends for either way
    that it may begin.
    """
    opens, closes = _changes(F.col("value"))
    flips = lines.select("file", "offset", opens.alias("opens"), closes.alias("closes")).filter("opens or closes")
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())])

    def run(batches):
        ends: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            for file, offset, opens, closes in zip(*(batch.column(k).to_pylist() for k in ("file", "offset", "opens", "closes"))):
                state = ends.setdefault((file, offset), [False, True])
                state[:] = [not closes if inside else opens for inside in state]
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*split, *state))) for split, state in ends.items()], schema)

    changes = {(r.file, r.offset): (r.outside, r.inside) for r in flips.mapInArrow(run, "file string, offset long, outside boolean, inside boolean").collect()}
    if not any(outside for outside, _ in changes.values()):
        return set()
    found, inside, last = set(), False, None
    for r in sorted(lines.select("file", "offset").distinct().collect()):
        inside = inside and r.file == last
        last = r.file
        if inside:
            found.add((r.file, r.offset))
        inside = changes.get((r.file, r.offset), (False, True))[inside]
    return found


class _Split:
    """A split's lines, to its records and what it holds of records that cross its ends."""

    def __init__(self, inside: bool):
        self.head, self.held, self.inside = [], "", inside

    def add(self, line: str) -> str | None:
        line = line.removesuffix("\r")
        if self.inside:
            self.head.append(line)
            self.inside = re.sub(r"\\.", "", line).count('"') % 2 == 0
        elif self.held or not _SKIPPED.match(line):
            self.held = f"{self.held}\n{line}" if self.held else line
            if '"' not in self.held or not _open_string(self.held):
                record, self.held = self.held, ""
                return record
        return None

    def rest(self):
        """(text, whether a record begins with it) of records that are not whole."""
        if self.head:
            yield "\n".join(self.head), False
        if self.held:
            yield self.held, True


def _records_of(batches, crossing: set[tuple[str, int]]):
    """Lines to whole records, and pieces of others with their split."""
    schema = pa.schema([("record", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("first", pa.bool_())])
    at, split, out = None, _Split(False), []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else ((),) * 4, schema)], schema=schema)

    def rest():
        for text, first in split.rest():
            if not crossing:
                raise LineProtocolError("a string that does not end before the input does")
            out.append((text, *at, first))

    for batch in batches:
        for line, *here in zip(*(batch.column(k).to_pylist() for k in ("value", "file", "offset"))):
            if here != at:
                rest()
                at, split = here, _Split(tuple(here) in crossing)
            if (record := split.add(line)) is not None:
                out.append((record, None, None, None))
        yield batch_of(out)
        out.clear()
    rest()
    yield batch_of(out)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The logical records of files on any store that Spark reads (gzip by name), split as Spark splits text.

    The driver gets a row for each split that has a line whose quotes don't pair.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"))
    crossing = _crossing(lines)
    read = lambda df: df.mapInArrow(lambda it: _records_of(it, crossing), "record string, file string, offset long, first boolean")
    whole = spread(read(lines).filter("file is null").select("record"))
    if not crossing:
        return whole
    # only splits on either side of a crossing have pieces, a record's first and those that go on with it
    order = Window.partitionBy("file").orderBy("offset", "first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = sorted({file for file, _ in crossing})
    pieces = read(lines.filter(F.col("file").isin(files))).filter("file is not null").withColumn("number", F.sum(F.col("first").cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("offset", "first", "record")))
    joined = pieces.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined.select("record"))


def read_files(spark: SparkSession, path: str, registry: Registry | None = None) -> DataFrame:
    """Points of files, with identities."""
    return decode_identified(read_records(spark, path), registry=registry)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        opener = gzip.open if partition.path.endswith(".gz") else open
        with opener(partition.path, "rb") as stream:
            yield from batches_of(records(stream))


class LineProtocolSource(DataSource):
    """``spark.read.format("line_protocol").load(glob)``, for paths that executors have mounted."""

    @classmethod
    def name(cls) -> str:
        return "line_protocol"

    def schema(self) -> StructType | str:
        return POINTS

    def reader(self, schema: StructType) -> DataSourceReader:
        pattern = self.options.get("path", "")
        paths = sorted(glob.glob(pattern, recursive=True))
        if not paths:
            raise ValueError(f"no files match {pattern!r}")
        return _Reader(paths)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LineProtocolSource)


def escape_key(text):
    """A column or text as a tag or field key (a measurement's ``=`` needs no escape, and takes one)."""
    return F.regexp_replace(text, r"([,= ])", r"\\$1")
