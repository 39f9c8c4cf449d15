"""NetCDF files in the 64-bit classic format (CDF-5), written by many tasks at known places and read by ranges of rows.

All variables run along one dimension, so a variable is one run of bytes and a
row's place in it is known once the rows before it are counted:

1. Rows are dealt by ranges of (file, order), sorted, and turned to pieces: the
   big-endian bytes of each variable of some rows. Pieces are written as a table,
   so what follows never sorts again.
2. Counts by file and partition, added up, give each piece its first row. The
   driver writes headers (a few kilobytes) into files of their full size.
3. Tasks write each piece's bytes at their places, then read them back and compare
   checksums. A task that runs again writes the same bytes to the same places.
4. One rename for each file publishes it.

Texts have no width of their own: ``x`` holds the bytes of all rows' texts and
``x_end`` where each ends; null texts are empty ones. Null floats are NaN; other
nulls are errors. A file without rows has a header alone.
"""

from __future__ import annotations

import os
import uuid
import zlib
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tsforge.operators import store

# Fixed values of the format.
MAGIC = b"CDF\x05"
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
CODES = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6, "u1": 7, "u2": 8, "u4": 9, "i8": 10, "u8": 11}
_KINDS = {v: k for k, v in CODES.items()}

ROWS = "observation"
#: Rows of a piece at most, and of a range that is read at once.
PIECE, RANGE = 65_536, 1 << 20

_SPARK = {"i1": "tinyint", "i2": "smallint", "i4": "int", "f4": "float", "f8": "double", "u1": "smallint", "u2": "int", "u4": "long", "i8": "long", "u8": "decimal(20,0)"}
_ARROW = {"i1": pa.int8(), "i2": pa.int16(), "i4": pa.int32(), "f4": pa.float32(), "f8": pa.float64(), "u1": pa.int16(), "u2": pa.int32(), "u4": pa.int64(), "i8": pa.int64(), "u8": pa.decimal128(20, 0)}


class CdfError(ValueError):
    """A file that is not in the format, or does not hold what it should."""


@dataclass(frozen=True)
class Variable:
    """A column: ``kind`` is a number's type, ``text``, or ``u1`` with a ``width`` for binaries of that many bytes."""

    name: str
    kind: str
    attributes: dict = field(default_factory=dict)
    width: int = 0

    @property
    def size(self) -> int:
        """Bytes of a row (of a text's end)."""
        return 8 if self.kind == "text" else int(self.kind[1:]) * max(self.width, 1)


# ---------------------------------------------------------------- the header


def _number(n: int) -> bytes:
    return n.to_bytes(8, "big")


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 4)


def _name(text: str) -> bytes:
    said = text.encode("utf-8")
    return _number(len(said)) + _padded(said)


def _list(tag: int, items: list[bytes]) -> bytes:
    return (tag if items else 0).to_bytes(4, "big") + _number(len(items)) + b"".join(items)


def _attribute(name: str, value) -> bytes:
    if isinstance(value, str):
        said = value.encode("utf-8")
        return _name(name) + CODES["S1"].to_bytes(4, "big") + _number(len(said)) + _padded(said)
    values = np.atleast_1d(np.asarray(value))
    values = values.astype(np.int64) if values.dtype == bool else values
    kind = f"{values.dtype.kind}{values.dtype.itemsize}"
    return _name(name) + CODES[kind].to_bytes(4, "big") + _number(len(values)) + _padded(values.astype(values.dtype.newbyteorder(">")).tobytes())


@dataclass(frozen=True)
class Layout:
    """Where everything of a file is: the header's bytes, the begin of each run, the file's size."""

    header: bytes
    begins: dict[str, int]
    size: int


def layout(variables: list[Variable], rows: int, texts: dict[str, int], attributes: dict) -> Layout:
    """From counts alone: rows, and bytes of each text variable."""
    dimensions = [(ROWS, rows)] + [(f"{v.name}_width", v.width) for v in variables if v.width] + [(f"{v.name}_chars", max(texts[v.name], 1)) for v in variables if v.kind == "text"]
    number = {name: i for i, (name, _) in enumerate(dimensions)}
    runs: list[tuple[str, list[str], dict, str, int]] = []
    for v in variables:
        if v.kind == "text":
            runs.append((v.name, [f"{v.name}_chars"], v.attributes, "S1", max(texts[v.name], 1)))
            runs.append((f"{v.name}_end", [ROWS], {"long_name": f"end of each row's text in {v.name}"}, "i8", 8 * rows))
        else:
            runs.append((v.name, [ROWS] + [f"{v.name}_width"] * bool(v.width), v.attributes, v.kind, v.size * rows))

    def made(begins: list[int]) -> bytes:
        said = [_name(name) + _number(length) for name, length in dimensions]
        listed = [_attribute(k, v) for k, v in attributes.items()]
        variables_ = []
        for (name, of, own, kind, size), begin in zip(runs, begins):
            # without rows the dimension is a record's, and the size is that of one
            each = size if rows or of[0] != ROWS else next(v.size for v in variables if name in (v.name, f"{v.name}_end"))
            attrs = _list(ATTRIBUTE, [_attribute(k, v) for k, v in own.items()])
            variables_.append(_name(name) + _number(len(of)) + b"".join(_number(number[d]) for d in of) + attrs + CODES[kind].to_bytes(4, "big") + _number(each + -each % 4) + _number(begin))
        return MAGIC + _number(0) + _list(DIMENSION, said) + _list(ATTRIBUTE, listed) + _list(VARIABLE, variables_)

    at, begins = len(made([0] * len(runs))), []
    for *_, size in runs:
        begins.append(at)
        at += size + -size % 4
    return Layout(made(begins), {name: b for (name, *_), b in zip(runs, begins)}, at)


class _Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise CdfError("a header that is cut short")
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self, size: int = 8) -> int:
        return int.from_bytes(self.take(size), "big")

    def name(self) -> str:
        n = self.number()
        return self.take(n + -n % 4)[:n].decode("utf-8")

    def items(self, tag: int, one) -> list:
        found, n = self.number(4), self.number()
        if found not in (0, tag) or (found == 0 and n):
            raise CdfError("a header with an unknown part")
        return [one() for _ in range(n)]

    def attribute(self) -> tuple[str, object]:
        name, code, n = self.name(), self.number(4), self.number()
        kind = _KINDS.get(code)
        if kind is None:
            raise CdfError(f"unknown type {code}")
        size = n * int(kind[1:])
        data = self.take(size + -size % 4)[:size]
        if kind == "S1":
            return name, data.decode("utf-8")
        values = np.frombuffer(data, f">{kind}")
        return name, values.astype(kind) if n != 1 else values[0].item()

    def variable(self) -> tuple[str, dict]:
        name = self.name()
        of = [self.number() for _ in range(self.number())]
        attributes = dict(self.items(ATTRIBUTE, self.attribute))
        code, _, begin = self.number(4), self.number(), self.number()
        return name, {"dimensions": of, "attributes": attributes, "kind": _KINDS[code], "begin": begin}


def read_header(path: str) -> dict:
    """Dimensions, attributes and variables (with their kinds, dimensions and begins) of a file."""
    size, take = os.path.getsize(path), 1 << 20
    while True:
        with open(path, "rb") as file:
            data = file.read(take)
        if data[:4] != MAGIC:
            raise CdfError(f"{path} is not in this format")
        cursor = _Cursor(data)
        try:
            cursor.take(4)
            cursor.number()
            dimensions = cursor.items(DIMENSION, lambda: (cursor.name(), cursor.number()))
            attributes = dict(cursor.items(ATTRIBUTE, cursor.attribute))
            variables = dict(cursor.items(VARIABLE, cursor.variable))
            break
        except CdfError:
            if take >= size:
                raise
            take *= 8
    for v in variables.values():
        v["dimensions"] = [dimensions[d][0] for d in v["dimensions"]]
    return {"dimensions": dict(dimensions), "attributes": attributes, "variables": variables, "size": size}


# ---------------------------------------------------------------- writing


def _bytes_of(column: pa.Array, v: Variable) -> tuple[bytes, int]:
    """A column's bytes, and how many bytes of text."""
    if v.kind == "text":
        said = pc.fill_null(column.cast(pa.string()), "").cast(pa.binary())
        ends = np.cumsum(pc.binary_length(said).to_numpy(zero_copy_only=False).astype(np.int64))
        data = b"".join(said.to_pylist())
        return ends.astype(">i8").tobytes() + data, len(data)
    if v.width:
        data = b"".join(column.to_pylist())
        if len(data) != v.width * len(column):
            raise CdfError(f"{v.name}: not {v.width} bytes each")
        return data, 0
    if v.kind[0] == "f":
        column = pc.fill_null(column.cast(pa.float64()), float("nan"))
    elif column.null_count:
        raise CdfError(f"{v.name}: a null, which this type can't say")
    numbers = column.cast(pa.from_numpy_dtype(np.dtype(v.kind))).to_numpy(zero_copy_only=False)
    return numbers.astype(f">{v.kind}").tobytes(), 0


def _pieces(batches, variables: list[Variable], by: str):
    """Sorted rows to pieces: file, part, number, rows, text bytes and bytes of each variable."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("n", pa.int64()), ("chars", pa.list_(pa.int64())), ("data", pa.list_(pa.binary()))])
    for batch in batches:
        files = batch.column(by)
        cuts = [0, *(np.flatnonzero(np.array(pc.not_equal(files[1:], files[:-1]).to_pylist(), bool)) + 1).tolist(), len(files)]
        for a, b in zip(cuts, cuts[1:]):
            for at in range(a, b, PIECE):
                own = batch.slice(at, min(PIECE, b - at))
                made = [_bytes_of(own.column(v.name), v) for v in variables]
                row = {"file": files[at].as_py(), "part": part, "number": number, "n": own.num_rows, "chars": [c for _, c in made], "data": [d for d, _ in made]}
                number += 1
                yield pa.RecordBatch.from_pylist([row], schema=schema)


def _write_pieces(batches, variables: list[Variable], places: dict[str, tuple[str, dict[str, int]]]):
    """Pieces with their first rows to their places, read back and compared."""
    for batch in batches:
        for p in batch.to_pylist():
            path, begins = places[p["file"]]
            with open(path, "r+b") as file:
                for v, data, chars, before in zip(variables, p["data"], p["chars"], p["chars_before"]):
                    runs = [(begins[v.name] + p["first"] * v.size, data)]
                    if v.kind == "text":
                        ends = (np.frombuffer(data, ">i8", p["n"]).astype(np.int64) + before).astype(">i8").tobytes()
                        runs = [(begins[f"{v.name}_end"] + p["first"] * 8, ends), (begins[v.name] + before, data[len(ends) :])]
                    for at, said in runs:
                        file.seek(at)
                        file.write(said)
                        file.flush()
                        file.seek(at)
                        if zlib.crc32(file.read(len(said))) != zlib.crc32(said):
                            raise CdfError(f"{path} does not hold what was written")
            yield pa.RecordBatch.from_pylist([{"file": p["file"], "n": p["n"]}], schema=pa.schema([("file", pa.string()), ("n", pa.int64())]))


def write(rows: DataFrame, by: str, order: list[str], variables: list[Variable], paths: dict[str, str], attributes: dict[str, dict], partitions: int | None = None) -> dict[str, int]:
    """Rows to files, by the text column ``by`` in the given order; how many rows each holds.

    ``paths`` and ``attributes`` are by the values of ``by``; a file is made for each, with rows or without.
    Files lie in a folder that executors share, and appear there when they are whole.
    """
    spark = rows.sparkSession
    names = [v.name for v in variables]
    n = [partitions] if partitions else []
    dealt = rows.select(by, *dict.fromkeys([*order, *names])).repartitionByRange(*n, by, *order).sortWithinPartitions(by, *order).select(by, *names)
    made = dealt.mapInArrow(lambda batches: _pieces(batches, variables, by), "file string, part int, number int, n long, chars array<long>, data array<binary>")
    folder = store.scratch(spark, "pieces")
    made.write.parquet(folder)
    pieces = spark.read.schema(made.schema).parquet(folder)
    sums = [F.sum("n").alias("n"), *[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(variables))]]
    counts = pieces.groupBy("file", "part").agg(*sums).orderBy("file", "part").collect()  # a row for each file and partition
    before, totals = [], {}
    for r in counts:
        had = totals.setdefault(r.file, [0] * (1 + len(variables)))
        before.append((r.file, r.part, *had))
        totals[r.file] = [a + b for a, b in zip(had, r[2:])]
    if unknown := totals.keys() - paths.keys():
        raise CdfError(f"rows of files that have no path: {sorted(unknown)[:5]}")
    places: dict[str, tuple[str, dict[str, int]]] = {}
    try:
        return _placed(pieces, before, totals, variables, paths, attributes, places)
    finally:
        for part, _ in places.values():
            Path(part).unlink(missing_ok=True)
        store.Files(spark).delete(folder)


def _placed(pieces: DataFrame, before: list[tuple], totals: dict[str, list[int]], variables: list[Variable], paths: dict[str, str], attributes: dict[str, dict], places: dict[str, tuple[str, dict[str, int]]]) -> dict[str, int]:
    """Headers, then pieces at their places, then names; what isn't renamed is left in ``places``."""
    spark = pieces.sparkSession
    for key, path in paths.items():
        n_rows, *chars = totals.get(key, [0] * (1 + len(variables)))
        where = layout(variables, n_rows, {v.name: c for v, c in zip(variables, chars)}, attributes[key])
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        places[key] = (f"{path}.{uuid.uuid4().hex}.part", where.begins)
        with open(places[key][0], "wb") as file:
            file.write(where.header)
            file.truncate(where.size)
    columns = [f"before_{i}" for i in range(1 + len(variables))]
    offsets = spark.createDataFrame(before, f"file string, part int, {', '.join(f'{c} long' for c in columns)}")
    inside = Window.partitionBy("file", "part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    firsts = pieces.select("file", "part", "number", "n", "chars")
    firsts = firsts.select("file", "part", "number", earlier("n").alias("_0"), *[earlier(F.col("chars")[i]).alias(f"_{i + 1}") for i in range(len(variables))])
    firsts = firsts.join(offsets, ["file", "part"]).select("file", "part", "number", (F.col("_0") + F.col("before_0")).alias("first"), F.array(*[F.col(f"_{i + 1}") + F.col(f"before_{i + 1}") for i in range(len(variables))]).alias("chars_before"))
    placed = pieces.join(firsts, ["file", "part", "number"])
    done = placed.mapInArrow(lambda batches: _write_pieces(batches, variables, places), "file string, n long").groupBy("file").agg(F.sum("n").alias("n")).collect()
    wrote = {r.file: r.n for r in done}
    for key, (part, _) in places.items():
        expected = totals.get(key, [0])[0]
        if wrote.get(key, 0) != expected or read_header(part)["dimensions"][ROWS] != expected:
            raise CdfError(f"{paths[key]}: {wrote.get(key, 0)} rows of {expected}")
        os.replace(part, paths[key])
    return {key: totals.get(key, [0])[0] for key in paths}


# ---------------------------------------------------------------- reading


def _columns(header: dict) -> list[Variable]:
    """The variables along rows."""
    out = []
    for name, v in header["variables"].items():
        dims = v["dimensions"]
        if dims == [f"{name}_chars"]:
            out.append(Variable(name, "text", v["attributes"]))
        elif dims[0] == ROWS and not (name.endswith("_end") and f"{name[:-4]}_chars" in header["dimensions"]):
            out.append(Variable(name, v["kind"], v["attributes"], header["dimensions"][dims[1]] if len(dims) > 1 else 0))
    return out


def _read_rows(path: str, header: dict, columns: list[Variable], first: int, last: int) -> pa.RecordBatch:
    n, arrays = last - first, []
    with open(path, "rb") as file:

        def run(name: str, at: int, size: int) -> bytes:
            file.seek(header["variables"][name]["begin"] + at)
            data = file.read(size)
            if len(data) != size:
                raise CdfError(f"{path} is cut short")
            return data

        for v in columns:
            if v.kind == "text":
                start = max(first - 1, 0)
                ends = np.frombuffer(run(f"{v.name}_end", start * 8, (last - start) * 8), ">i8").astype(np.int64)
                ends = ends if first else np.r_[0, ends]
                if (np.diff(ends) < 0).any() or int(ends[-1]) > header["dimensions"][f"{v.name}_chars"]:
                    raise CdfError(f"{path}: ends of {v.name} that are out of order")
                data = run(v.name, int(ends[0]), int(ends[-1] - ends[0]))
                arrays.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(data)]).cast(pa.binary()).cast(pa.string()))
            elif v.width:
                arrays.append(pa.FixedSizeBinaryArray.from_buffers(pa.binary(v.width), n, [None, pa.py_buffer(run(v.name, first * v.size, n * v.size))]).cast(pa.binary()))
            else:
                numbers = pa.array(np.frombuffer(run(v.name, first * v.size, n * v.size), f">{v.kind}").astype(v.kind))
                arrays.append(numbers.cast(_ARROW[v.kind]))
    return pa.RecordBatch.from_arrays(arrays, names=[v.name for v in columns])


def read(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The rows of a file, or of several with the same variables and then with ``file``; a task for each range of rows.

    Unsigned 64-bit numbers come as decimals.
    """
    paths = [path] if isinstance(path, str) else path
    headers = {p: read_header(p) for p in paths}
    every = {p: _columns(h) for p, h in headers.items()}
    columns = every[paths[0]]
    if any([(v.name, v.kind, v.width) for v in own] != [(v.name, v.kind, v.width) for v in columns] for own in every.values()):
        raise CdfError("files with different variables")
    schema = ", ".join(f"`{v.name}` {'string' if v.kind == 'text' else 'binary' if v.width else _SPARK[v.kind]}" for v in columns)
    ranges = [(p, at, min(at + RANGE, n)) for p in paths for n in [headers[p]["dimensions"][ROWS]] for at in range(0, n, RANGE)]
    many = not isinstance(path, str)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for at in range(r["first"], r["last"], PIECE):
                    made = _read_rows(r["file"], headers[r["file"]], columns, at, min(at + PIECE, r["last"]))
                    yield made.append_column("file", pa.array([r["file"]] * made.num_rows)) if many else made

    rows = spark.createDataFrame(ranges, "file string, first long, last long").repartition(max(1, min(len(ranges), 4096)), "file", "first")
    return rows.mapInArrow(run, schema + ", file string" * many)
