"""Time-structured merge (TSM) files: read by ranges of blocks, indexed by their footers, written by partitions.

A file is blocks, then an index with the series, field, times and place of each
block, then the index's place. A scan has two steps. First the footers alone are
read, a task for some files, and blocks whose times or series nobody asked for
are dropped there. Then what is left is dealt by ranges of bytes (``SLOT``) and
of blocks (``DEALT``, as blocks of steady values are a few bytes), so that a
large file is many tasks and its blocks are read in runs and decoded many at a
time (``tsm_codec``).

Files lie where executors have them mounted. A block that can't be read raises,
or is a row with its file and ``error`` (``strict=False``), so that one broken
file stops no other. Points are as the files say: a point that several files
hold comes several times, and ``newest`` keeps that of the last file. Points of
one series and time in one file are kept too. An index without entries, a file
without blocks and a folder without files give no rows.
"""

from __future__ import annotations

import glob
import os
import shutil
import struct
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain, groupby
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from tsforge.functions.identity import Registry, python_identity
from tsforge.operators import store
from tsforge.schema import IDENTIFIED_POINTS, POINTS, VALUE_TYPES
from tsforge.sources import tsm_codec as codec
from tsforge.sources.line_protocol import IDENTIFIED, SCHEMA, LineProtocolError, parse_series
from tsforge.sources.tsm_codec import KINDS, MAGIC, SEPARATOR, VERSION, TsmError

#: Bytes of a file whose blocks are one task's; bytes of blocks decoded together; a gap that is read rather than skipped.
SLOT, TOGETHER, GAP = 32 << 20, 4 << 20, 64 << 10
#: Blocks of a file that are one task's at most, however small they are.
DEALT = 500
#: Points in a block that is written, in a file (more or less), and that are encoded together.
BLOCK, PER_FILE, ENCODED = 1000, 1_000_000, 100_000
#: Rows of an index in a batch, and series that a task keeps.
ROWS, KEPT = 20_000, 20_000

_ENTRY = np.dtype([("low", ">i8"), ("high", ">i8"), ("offset", ">i8"), ("size", ">u4")])
_INDEX = "file string, measurement string, series_key string, field string, value_type string, minimum_time long, maximum_time long, offset long, size long, error string"
_INDEX_TYPES = pa.schema([("file", pa.string()), ("measurement", pa.string()), ("series_key", pa.string()), ("field", pa.string()), ("value_type", pa.string()), *((k, pa.int64()) for k in ("minimum_time", "maximum_time", "offset", "size")), ("error", pa.string())])
SCANNED = f"{IDENTIFIED_POINTS}, file string, error string"
_SCANNED = pa.schema([*IDENTIFIED, ("file", pa.string()), ("error", pa.string())])
_FOOTER = 8

Wanted = Callable[[str, str, dict[str, str]], bool]


# ---------------------------------------------------------------- the index


def read_index(path: str, low: int | None = None, high: int | None = None, wanted: Wanted | None = None) -> Iterator[tuple[str, str, str, str, np.ndarray]]:
    """From a file's footer: measurement, series key, field, type and entries of blocks that touch [low, high); nothing else is read."""
    with open(path, "rb") as file:
        size = file.seek(0, os.SEEK_END)
        if size < 5 + _FOOTER:
            raise TsmError("a file too short for its header and footer")
        file.seek(0)
        head = file.read(5)
        if head[:4] != MAGIC or head[4] != VERSION:
            raise TsmError("not a file of this format and version")
        file.seek(size - _FOOTER)
        start = struct.unpack(">q", file.read(_FOOTER))[0]
        if not 5 <= start <= size - _FOOTER:
            raise TsmError("an index outside its file")
        file.seek(start)
        index = file.read(size - _FOOTER - start)
    at, known, parsed = 0, None, None
    while at < len(index):
        try:
            n = struct.unpack_from(">H", index, at)[0]
            key = index[at + 2 : at + 2 + n]
            kind, count = struct.unpack_from(">BH", index, at + 2 + n)
            entries = np.frombuffer(index, _ENTRY, count, at + 5 + n)
        except (struct.error, ValueError) as e:
            raise TsmError("an index that is cut short") from e
        at += 5 + n + count * _ENTRY.itemsize
        if kind >= len(KINDS) or (entries["offset"] < 5).any() or (entries["offset"] + entries["size"] > start).any():
            raise TsmError("an index that points outside its blocks")
        if high is not None:
            entries = entries[entries["low"] < high]
        if low is not None:
            entries = entries[entries["high"] >= low]
        series, separator, field = key.decode("utf-8").partition(SEPARATOR)
        if not separator:
            raise TsmError("a key without a field")
        if len(entries):
            if series != known:  # the fields of a series stand together
                known, parsed = series, _parsed(series)
            measurement, tags = parsed
            if wanted is None or wanted(measurement, field, tags):
                yield measurement, series, field, KINDS[kind], entries


def _parsed(series: str) -> tuple[str, dict[str, str]]:
    try:
        return parse_series(series)
    except LineProtocolError as e:
        raise TsmError(str(e)) from e


def _index_batches(path: str, found: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Index rows of many keys in one batch."""
    said, entries, n = [], [], 0

    def batch() -> pa.RecordBatch:
        owner = pa.array(np.repeat(np.arange(len(said)), [len(e) for e in entries]))
        same = [pa.array(c, pa.string()).take(owner) for c in ([path] * len(said), *zip(*said))]
        every = np.concatenate(entries)
        numbers = [pa.array(every[k].astype(np.int64)) for k in ("low", "high", "offset", "size")]
        return pa.RecordBatch.from_arrays([*same, *numbers, pa.nulls(n, pa.string())], schema=_INDEX_TYPES)

    try:
        for *what, own in found:
            said.append(what)
            entries.append(own)
            n += len(own)
            if n >= ROWS:
                yield batch()
                said, entries, n = [], [], 0
    except TsmError:  # what stands before a broken place is given, as it was read
        if n:
            yield batch()
        raise
    if n:
        yield batch()


def _index_rows(batches, low, high, wanted):
    for batch in batches:
        for path in batch.column("file").to_pylist():
            try:
                yield from _index_batches(path, read_index(path, low, high, wanted))
            except (OSError, TsmError) as e:
                yield pa.RecordBatch.from_pylist([{"file": path, "error": str(e)}], schema=_INDEX_TYPES)


def files_of(path: str | Iterable[str]) -> list[str]:
    """Files of a glob, of a folder and those below it, or as listed."""
    if not isinstance(path, str):
        return sorted(path)
    found = glob.glob(f"{path}/**/*.tsm" if os.path.isdir(path) else path, recursive=True)
    return sorted(f for f in found if not Path(f).name.startswith("."))


def _in_order(parts: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += part.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def index(spark: SparkSession, path: str | Iterable[str] | DataFrame, low: int | None = None, high: int | None = None, wanted: Wanted | None = None) -> DataFrame:
    """The blocks of files (a glob, a folder, a list, or a table with ``file``) that touch [low, high), from their footers."""
    listed = path.select("file") if isinstance(path, DataFrame) else spark.createDataFrame([(f,) for f in files_of(path)], "file string")
    # by ranges and to a number of tasks, as few small rows are otherwise put together in one
    listed = listed.repartitionByRange(max(1, min(listed.count(), 4096)), "file")
    return listed.mapInArrow(lambda batches: _in_order(_index_rows(batches, low, high, wanted)), _INDEX)


def _tags(batches):
    for batch in batches:
        keys = batch.column("series_key").dictionary_encode()
        parsed = pa.array([list(parse_series(k)[1].items()) for k in keys.dictionary.to_pylist()], pa.map_(pa.string(), pa.string()))
        columns = {name: batch.column(name) for name in batch.schema.names if name != "series_key"} | {"tags": parsed.take(keys.indices)}
        yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])


def series_index(blocks: DataFrame) -> DataFrame:
    """An index by series and field: measurement, tags, field, type, files, blocks and times; a key is parsed once in a batch, and footers are read once."""
    keys = ("measurement", "series_key", "field", "value_type")
    rows = blocks.filter("error is null").groupBy(*keys).agg(F.count_distinct("file").alias("files"), F.count("*").alias("blocks"), F.min("minimum_time").alias("minimum_time"), F.max("maximum_time").alias("maximum_time"))
    return rows.mapInArrow(_tags, "measurement string, field string, value_type string, files long, blocks long, minimum_time long, maximum_time long, tags map<string,string>")


# ---------------------------------------------------------------- blocks to points


def _runs(offsets: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Numbers of blocks (sorted by place) that are read at once."""
    start = 0
    for i in range(1, len(offsets) + 1):
        end = offsets[i - 1] + sizes[i - 1]
        if i == len(offsets) or offsets[i] > end + GAP or offsets[i] + sizes[i] - offsets[start] > TOGETHER:
            yield start, i
            start = i


class _Points:
    """Decoded blocks as Arrow columns; what a series says is worked out once and taken by number."""

    def __init__(self, identify: Callable[[str, dict[str, str]], tuple] | None, low: int | None, high: int | None, schema: pa.Schema):
        self.identify, self.low, self.high, self.schema = identify, low, high, schema
        self.known: dict[str, tuple] = {}

    def _series(self, key: str) -> tuple:
        found = self.known.get(key)
        if found is None:
            measurement, tags = _parsed(key)
            if len(self.known) >= KEPT:
                self.known.clear()
            found = self.known[key] = (measurement, list(tags.items()), *(self.identify(measurement, tags) if self.identify else ()))
        return found

    def batch(self, file: str, kind: str, keys: list[str], fields: list[str], blocks: list[bytes]) -> pa.RecordBatch | None:
        decoded = codec.decode(kind, blocks)
        times = np.concatenate([t for t, _ in decoded])
        owner = np.repeat(np.arange(len(blocks)), [len(t) for t, _ in decoded])
        inside = np.ones(len(times), bool)
        if self.low is not None:
            inside &= times >= self.low
        if self.high is not None:
            inside &= times < self.high
        if not inside.any():
            return None
        if kind == "string":
            values = pa.array([v for _, part in decoded for v in part], pa.string()).filter(pa.array(inside))
        else:
            flat = np.concatenate([v for _, v in decoded])[inside]
            values = pa.array(flat.view(np.uint64)).cast(pa.decimal128(20, 0)) if kind == "uint64" else pa.array(flat)
        owner, n = pa.array(owner[inside]), int(inside.sum())
        said = [self._series(k) for k in keys]
        repeated = lambda i, t: pa.array([s[i] for s in said], t).take(owner)
        columns = {
            "measurement": repeated(0, pa.string()), "tags": repeated(1, pa.map_(pa.string(), pa.string())), "time_ns": pa.array(times[inside]),
            "field": pa.array(fields, pa.string()).take(owner), "value_type": pa.array([kind]).take(pa.array(np.zeros(n, np.int32))), f"value_{kind}": values,
        }
        if self.identify:
            columns |= {name: repeated(2 + i, self.schema.field(name).type) for i, name in enumerate(("series_id", "vsn", "sensor", "instrument_id", "identity_source"))}
        if "file" in self.schema.names:
            columns["file"] = pa.array([file]).take(pa.array(np.zeros(n, np.int32)))
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in self.schema], schema=self.schema)

    def file(self, path: str, keys: list[str], fields: list[str], kinds: list[str], offsets: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Points of a file's blocks, given in the order of their places."""
        with open(path, "rb") as file:
            for a, b in _runs(offsets, sizes):
                file.seek(int(offsets[a]))
                data = file.read(int(offsets[b - 1] + sizes[b - 1] - offsets[a]))
                for kind in sorted(set(kinds[a:b])):
                    own = [i for i in range(a, b) if kinds[i] == kind]
                    blocks = [data[offsets[i] - offsets[a] : offsets[i] - offsets[a] + sizes[i]] for i in own]
                    made = self.batch(path, kind, [keys[i] for i in own], [fields[i] for i in own], blocks)
                    if made is not None:
                        yield made


def _decode_slots(batches, registry, low, high, strict):
    """Index rows, sorted by file and place, to points; a broken range is an error or a row."""
    points = _Points(lambda m, t: python_identity(m, t, registry), low, high, _SCANNED)
    for batch in batches:
        files = batch.column("file").to_pylist()
        columns = [batch.column(c).to_pylist() for c in ("series_key", "field", "value_type")]
        offsets, sizes, errors = batch.column("offset").to_numpy(False), batch.column("size").to_numpy(False), batch.column("error").to_pylist()
        start = 0
        for i in range(1, len(files) + 1):
            if i < len(files) and files[i] == files[start] and errors[i] is None and errors[start] is None:
                continue
            error = errors[start]
            if error is None:
                try:
                    yield from points.file(files[start], *(c[start:i] for c in columns), offsets[start:i].astype(np.int64), sizes[start:i].astype(np.int64))
                except (OSError, ValueError) as e:
                    error = str(e)
            if error is not None:
                if strict:
                    raise TsmError(f"{files[start]}: {error}")
                yield pa.RecordBatch.from_pylist([{"file": files[start], "error": error}], schema=_SCANNED)
            start = i


def points(spark: SparkSession, blocks: DataFrame, low: int | None = None, high: int | None = None, registry: Registry | None = None, strict: bool = True) -> DataFrame:
    """Points of the blocks of an index (a written table) in [low, high), with identities, ``file`` and ``error`` (null unless not ``strict``)."""
    number = F.row_number().over(Window.partitionBy("file").orderBy("offset"))
    slots = blocks.withColumn("slot", F.struct(F.expr(f"offset div {SLOT}"), F.floor((number - 1) / DEALT)))
    n = slots.agg(F.count_distinct("file", "slot")).first()[0]
    dealt = slots.repartition(max(1, min(n, 20_000)), "file", "slot").sortWithinPartitions("file", "offset")
    return dealt.drop("slot").mapInArrow(lambda batches: _decode_slots(batches, registry, low, high, strict), SCANNED)


def scan(
    spark: SparkSession, path: str | Iterable[str] | DataFrame, low: int | None = None, high: int | None = None, wanted: Wanted | None = None, registry: Registry | None = None, strict: bool = True
) -> DataFrame:
    """Points of [low, high) of the series that are wanted, as ``points``."""
    return points(spark, store.kept(index(spark, path, low, high, wanted), "tsm-index"), low, high, registry, strict)


def newest(points: DataFrame) -> DataFrame:
    """Of the points of one series, field and time, that of the file with the last name (generation and sequence)."""
    name = F.element_at(F.split("file", "/"), -1)
    keys = ["series_id", "field", "time_ns"]
    rest = [c for c in points.columns if c not in keys]
    top = points.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(name, "file")).alias("top"))
    return top.select(*(F.col(c) if c in keys else F.col(f"top.{c}").alias(c) for c in points.columns))


# ---------------------------------------------------------------- the data source


class _Range(InputPartition):
    def __init__(self, file: str, rows: list[tuple], low: int | None, high: int | None):
        self.file, self.rows, self.low, self.high = file, rows, low, high


class _TsmReader(DataSourceReader):
    def __init__(self, files: list[str]):
        self.files, self.low, self.high, self.equal = files, None, None, {}

    def pushFilters(self, filters):  # noqa: N802 - the interface's name
        """Times cut the blocks and the points; equal measurements and fields cut the blocks, and Spark applies them again."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name == "time_ns" and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.low = max(x for x in (self.low, f.value + isinstance(f, GreaterThan)) if x is not None)
            elif name == "time_ns" and isinstance(f, LessThan | LessThanOrEqual):
                self.high = min(x for x in (self.high, f.value + isinstance(f, LessThanOrEqual)) if x is not None)
            else:
                if isinstance(f, EqualTo) and name in ("measurement", "field"):
                    self.equal[name] = f.value
                yield f

    def _wanted(self, measurement: str, field: str, tags: dict[str, str]) -> bool:
        return self.equal.get("measurement", measurement) == measurement and self.equal.get("field", field) == field

    def partitions(self):
        out = []
        for file in self.files:
            slots: dict[int, list[tuple]] = {}
            for _, series, field, kind, entries in read_index(file, self.low, self.high, self._wanted):
                for offset, size in zip(entries["offset"].tolist(), entries["size"].tolist()):
                    slots.setdefault(offset // SLOT, []).append((offset, size, series, field, kind))
            out += [_Range(file, sorted(rows), self.low, self.high) for _, rows in sorted(slots.items())]
        return out or [_Range("", [], None, None)]

    def read(self, partition):
        if partition.rows:
            offsets, sizes, keys, fields, kinds = map(list, zip(*partition.rows))
            yield from _Points(None, partition.low, partition.high, SCHEMA).file(partition.file, keys, fields, kinds, np.array(offsets, np.int64), np.array(sizes, np.int64))


class TsmSource(DataSource):
    """``spark.read.format("tsm").load(glob)``: the driver plans by footers, so it is for some hundred files; ``scan`` plans in the cluster."""

    @classmethod
    def name(cls) -> str:
        return "tsm"

    def schema(self) -> StructType | str:
        return POINTS

    def reader(self, schema: StructType) -> DataSourceReader:
        pattern = self.options.get("path", "")
        found = files_of(pattern)
        if not found:
            raise ValueError(f"no files match {pattern!r}")
        return _TsmReader(found)


def register(spark: SparkSession) -> None:
    """Filters are handed to Python sources only if the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TsmSource)


# ---------------------------------------------------------------- writing


def series_key(measurement: str | Column, tags: str | Column) -> Column:
    """The key of a series: tags sorted by name, with their escapes."""
    escaped = lambda c, what: reduce(lambda text, x: F.replace(text, F.lit(x), F.lit(f"\\{x}")), what, c)
    measurement, tags = (F.col(c) if isinstance(c, str) else c for c in (measurement, tags))
    each = F.transform(F.array_sort(F.map_entries(tags)), lambda e: F.concat(F.lit(","), escaped(e["key"], ",= "), F.lit("="), escaped(e["value"], ",= ")))
    return F.concat(escaped(measurement, ", "), F.array_join(each, ""))


class _Writer:
    """One file, block by block; its index lies in a temporary file until the end, but for the entries of the key at hand."""

    def __init__(self, path: str):
        self.path, self.part = path, f"{path}.{os.getpid()}.part"
        self.file, self.index = open(self.part, "wb"), tempfile.TemporaryFile()  # noqa: SIM115 - closed in finish
        self.file.write(MAGIC + bytes([VERSION]))
        self.at, self.points, self.blocks = 5, 0, 0
        self.key, self.kind, self.entries = None, None, []

    def add(self, key: str, kind: str, low: int, high: int, points: int, block: bytes) -> None:
        said = key.encode("utf-8")
        if len(said) > 0xFFFF:
            raise TsmError("a key of more than 65,535 bytes")
        if said != self.key or len(self.entries) == 0xFFFF:
            self._indexed()
        elif kind != self.kind:
            raise TsmError(f"values of two types under one key: {key}")
        self.key, self.kind = said, kind
        self.entries.append(struct.pack(">qqqI", low, high, self.at, len(block)))
        self.file.write(block)
        self.at += len(block)
        self.points += points
        self.blocks += 1

    def _indexed(self) -> None:
        if self.entries:
            self.index.write(struct.pack(">H", len(self.key)) + self.key + struct.pack(">BH", KINDS.index(self.kind), len(self.entries)) + b"".join(self.entries))
            self.entries = []

    def finish(self) -> dict:
        self._indexed()
        self.index.seek(0)
        shutil.copyfileobj(self.index, self.file, 1 << 20)
        self.index.close()
        self.file.write(struct.pack(">q", self.at))
        self.file.close()
        os.replace(self.part, self.path)  # a task that runs again writes the same file again
        return {"file": self.path, "blocks": self.blocks, "points": self.points}


def _values(kind: str, column: pa.Array):
    if column.null_count:
        raise TsmError("no null can be stored")
    if kind == "string":
        return column.to_pylist()
    return (column.cast(pa.uint64()) if kind == "uint64" else column).to_numpy(zero_copy_only=False)


def _blocks(rows: pa.Table, block: int, last: bool) -> tuple[list[tuple], pa.Table]:
    """Sorted points to blocks (key, type, times, points, bytes), all of a type encoded together; the last may go on, and its rows come back."""
    rows = rows.combine_chunks()
    keys, kinds, times = rows.column("_key").combine_chunks(), rows.column("value_type").combine_chunks(), rows.column("time_ns").to_numpy()
    n = len(times)
    other_key, other_kind = (np.r_[True, pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)] for c in (keys, kinds))
    if (two := np.flatnonzero(other_kind & ~other_key)).size:
        raise TsmError(f"values of two types under one key: {keys[int(two[0])].as_py()}")
    runs = np.flatnonzero(other_key)
    number = np.arange(n) - np.repeat(runs, np.diff(np.r_[runs, n]))
    starts = np.flatnonzero(number % block == 0)
    end = n if last else int(starts[-1])
    starts = starts[starts < end]
    if not len(starts):
        return [], rows
    sizes = np.diff(np.r_[starts, end])
    said = [x.take(pa.array(starts)).to_pylist() for x in (keys, kinds)]
    made: list = [None] * len(starts)
    for kind in sorted(set(said[1])):
        own = np.array([k == kind for k in said[1]])
        inside = np.repeat(own, sizes)
        values = _values(kind, rows.column(f"value_{kind}").slice(0, end).combine_chunks().filter(pa.array(inside)))
        for i, encoded in zip(np.flatnonzero(own).tolist(), codec.encode_all(kind, times[:end][inside], values, sizes[own])):
            made[i] = encoded
    return list(zip(*said, times[starts].tolist(), times[starts + sizes - 1].tolist(), sizes.tolist(), made)), rows.slice(end)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Batches cut where their folder changes, with its name."""
    for batch in batches:
        below = batch.column("_below")
        if below.null_count:
            raise TsmError("a point without a folder")
        edges = [0, *(np.flatnonzero(pc.not_equal(below[1:], below[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(below)]
        for a, b in zip(edges, edges[1:]):
            yield below[a].as_py(), batch.slice(a, b - a)


def _write_partition(batches, folder: str, block: int):
    """Sorted points to a file in each of their folders; the name has the partition's number as its sequence."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId()
    for name, own in groupby(_cut(b for b in batches if b.num_rows), itemgetter(0)):
        yield from _write_file((b for _, b in own), f"{folder}/{name}" if name else folder, number, block)


def _write_file(batches, folder: str, number: int, block: int):
    writer, held, n = None, [], 0
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            n += batch.num_rows
        if n and (batch is None or n >= max(ENCODED, 2 * block)):
            if writer is None:
                os.makedirs(folder, exist_ok=True)
                writer = _Writer(f"{folder}/000000001-{number + 1:09d}.tsm")
            found, rest = _blocks(pa.concat_tables(held), block, batch is None)
            for made in found:
                writer.add(*made)
            held, n = [rest], rest.num_rows
    if writer is not None:
        yield pa.RecordBatch.from_pylist([writer.finish()], schema=pa.schema([("file", pa.string()), ("blocks", pa.int64()), ("points", pa.int64())]))


def write(points: DataFrame, folder: str, files: int, block: int = BLOCK, below: str | None = None) -> DataFrame:
    """Points to files, a task each, dealt by ranges of key and time; the files, blocks and points that were written.

    There are ``files`` of them, or as many as keep each near ``PER_FILE`` points. The folder is one that executors share. A long series spans several files. Values of NaN or null can't be stored.
    ``below`` is a column with the folder below it that a point goes to: all folders are one job, and a task that meets the end of one goes on with the next.
    """
    key = F.concat(series_key("measurement", "tags"), F.lit(SEPARATOR), F.col("field")).alias("_key")
    place = (F.col(below) if below else F.lit("")).alias("_below")
    rows = points.select(place, key, "time_ns", "value_type", *(f"value_{k}" for k in VALUE_TYPES))
    # written once: counted, sampled for its ranges and dealt, the points are worked out no more than that
    path = store.scratch(points.sparkSession, "tsm-points")
    rows.write.options(**store.OPTIONS).parquet(path)
    rows = points.sparkSession.read.schema(rows.schema).parquet(path)
    order = ("_below", "_key", "time_ns")
    dealt = rows.repartitionByRange(max(files, -(-rows.count() // PER_FILE)), *order).sortWithinPartitions(*order)
    made = dealt.mapInArrow(lambda batches: _write_partition(batches, folder, block), "file string, blocks long, points long")
    return store.kept(made, "tsm-written")
