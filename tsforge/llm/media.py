"""Media columns: Netpbm and BMP images as binary columns, decoded to numpy arrays.

``decode`` reads P1 to P6 and uncompressed BMP of 1, 4, 8, 24 and 32 bits.
``area_resize`` averages the area under each output pixel exactly, from an
integral image that is kept only at the rows where the output needs it.
``difference_hash`` compares neighbours of a 9 by 8 reduction. ``npy_tiles`` cuts
an image in square tiles, each an NPY file, padded at the edges.

``store_texts`` is for bytes that are no image: a text's are padded with 255 to
whole 24 by 24 tiles, made an 8-bit grey PGM, 24 wide, that is decoded, cut in NPY
tiles and written. ``payload_features`` reads the tiles back: their checksums, and
the hash of the image after its resize, are of what was stored.

Defined results: a null text or image counts as empty bytes; an empty payload
is one tile of padding; bytes that are no supported image raise ValueError, or
give null columns where ``errors="null"``; repeated rows each get a row. An
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.llm.common import small_batches, text_of, written

TILE = 24
PAD = 255

_HEADER = re.compile(rb"P([1-6])(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)")
_MAXIMUM = re.compile(rb"(?:\s|#[^\n]*\n)+(\d+)")


def decode(data: bytes) -> np.ndarray:
    """An image as an array of height by width, by 3 or 4 if it has colours."""
    if data[:2] == b"BM":
        return _decode_bmp(data)
    head = _HEADER.match(data)
    if not head:
        raise ValueError("neither Netpbm nor BMP")
    kind, width, height = (int(x) for x in head.groups())
    at, most = head.end(), 1
    if kind not in (1, 4):
        found = _MAXIMUM.match(data, at)
        if not found:
            raise ValueError("a Netpbm image without its maximum")
        at, most = found.end(), int(found[1])
    if not 0 < most < 65536:
        raise ValueError("a Netpbm maximum out of range")
    shape = (height, width, 3) if kind in (3, 6) else (height, width)
    n = int(np.prod(shape))
    if kind < 4:
        text = re.sub(rb"#[^\n]*", b" ", data[at:])
        values = np.array([int(x) for x in (re.findall(rb"[01]", text) if kind == 1 else text.split())[:n]], np.uint16)
    elif kind == 4:
        row = (width + 7) // 8
        bits = np.unpackbits(np.frombuffer(data, np.uint8, min(row * height, len(data) - at - 1), at + 1))
        if len(bits) < row * height * 8:
            raise ValueError("a Netpbm image is cut short")
        values = bits.reshape(height, row * 8)[:, :width].reshape(-1)
    else:
        size = 1 + (most > 255)
        values = np.frombuffer(data, ">u2" if size == 2 else np.uint8, min(n, (len(data) - at - 1) // size), at + 1)
    if len(values) < n:
        raise ValueError("a Netpbm image is cut short")
    values = values.reshape(shape)
    if kind in (1, 4):  # here a set bit is black
        return (255 * (1 - values)).astype(np.uint8)
    return values.astype(np.uint8 if most < 256 else np.uint16)


def _decode_bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise ValueError("a BMP header is cut short")
    at, size, width, height, _, depth, packing = struct.unpack_from("<10xI IiiHHI", data)
    colours = struct.unpack_from("<I", data, 46)[0] or (1 << depth if depth <= 8 else 0)
    if packing not in (0, 3) or depth not in (1, 4, 8, 24, 32) or width <= 0 or not height:
        raise ValueError("a BMP of an unsupported kind")
    row = (width * depth + 31) // 32 * 4
    if len(data) < at + row * abs(height):
        raise ValueError("a BMP is cut short")
    lines = np.frombuffer(data, np.uint8, row * abs(height), at).reshape(abs(height), row)
    lines = lines[::-1] if height > 0 else lines
    if depth > 8:
        pixels = lines[:, : width * depth // 8].reshape(abs(height), width, depth // 8)
        return pixels[:, :, [2, 1, 0, 3][: depth // 8]]
    if depth == 8:
        index = lines[:, :width]
    elif depth == 4:
        index = np.stack([lines >> 4, lines & 15], -1).reshape(abs(height), -1)[:, :width]
    else:
        index = np.unpackbits(lines, axis=1)[:, :width]
    palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + size).reshape(-1, 4)[:, 2::-1]
    if index.size and index.max() >= len(palette):
        raise ValueError("a BMP pixel without a colour")
    shown = palette[index]
    return shown[:, :, 0] if (palette[:, :1] == palette).all() else shown


def encode_pgm(samples: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """An 8-bit grey BMP, bottom row first."""
    height, width = samples.shape
    row = (width + 3) // 4 * 4
    lines = np.zeros((height, row), np.uint8)
    lines[:, :width] = samples[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy()
    palette[:, 3] = 0
    at = 54 + 1024
    head = struct.pack("<2sIHHI IiiHHIIiiII", b"BM", at + lines.size, 0, 0, at, 40, width, height, 1, 8, 0, lines.size, 2835, 2835, 256, 0)
    return head + palette.tobytes() + lines.tobytes()


def grey(image: np.ndarray) -> np.ndarray:
    """The mean of the colours, without the alpha channel."""
    return image[:, :, :3].mean(axis=2) if image.ndim == 3 else image


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The exact mean of the area under each output pixel, as floats."""
    h, w = image.shape
    y, x = np.arange(height + 1) * (h / height), np.arange(width + 1) * (w / width)
    y0, x0 = np.minimum(y.astype(np.int64), h - 1), np.minimum(x.astype(np.int64), w - 1)
    rows, total, before = np.zeros((height + 1, w)), np.zeros(w), 0
    for k in range(height + 1):  # the integral image at row y[k]
        if y0[k] > before:
            total = total + image[before : y0[k]].sum(axis=0, dtype=np.float64)
            before = y0[k]
        rows[k] = total + (y[k] - y0[k]) * image[y0[k]]
    integral = np.concatenate([np.zeros((height + 1, 1)), np.cumsum(rows, axis=1)], axis=1)
    at = integral[:, x0] + (x - x0) * (integral[:, x0 + 1] - integral[:, x0])
    sums = at[1:, 1:] - at[:-1, 1:] - at[1:, :-1] + at[:-1, :-1]
    return sums / (h / height * (w / width))


def difference_hash(image: np.ndarray) -> str:
    """16 hexadecimal digits: whether each pixel of a 9 by 8 reduction is darker than the next."""
    small = np.round(area_resize(grey(image), 8, 9), 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


@functools.lru_cache(64)
def _npy_head(shape: tuple[int, ...], kind: str) -> bytes:
    """What stands before the values in an NPY file of this shape."""
    np.lib.format.write_array_header_1_0(buffer := io.BytesIO(), {"descr": kind, "fortran_order": False, "shape": shape})
    return buffer.getvalue()


@functools.lru_cache(64)
def _npy_meaning(head: bytes) -> tuple[tuple[int, ...], np.dtype]:
    buffer = io.BytesIO(head)
    if np.lib.format.read_magic(buffer) != (1, 0):
        raise ValueError("an NPY file of another version")
    shape, fortran, kind = np.lib.format.read_array_header_1_0(buffer)
    if fortran:
        raise ValueError("an NPY file in column order")
    return shape, kind


def npy_tiles(image: np.ndarray, tile: int = TILE) -> list[bytes]:
    """The image's tiles from left to right and top to bottom, each an NPY file."""
    h, w = image.shape[:2]
    rest = image.shape[2:]
    padded = image if not (h % tile or w % tile) else np.pad(image, ((0, -h % tile), (0, -w % tile), *[(0, 0)] * len(rest)), mode="edge")
    down, across = padded.shape[0] // tile, padded.shape[1] // tile
    cut = padded.reshape(down, tile, across, tile, *rest).swapaxes(1, 2)
    head, values = _npy_head((tile, tile, *rest), np.lib.format.dtype_to_descr(image.dtype)), cut.tobytes()
    size = len(values) // (down * across)
    return [head + values[i : i + size] for i in range(0, len(values), size)]


def read_tile(data: bytes) -> np.ndarray:
    """The array of an NPY file."""
    past = 10 + int.from_bytes(data[8:10], "little")
    shape, kind = _npy_meaning(data[:past])
    return np.frombuffer(data, kind, -1, past).reshape(shape)


def with_tiles(df: DataFrame, column: str = "media", tile: int = TILE, errors: str = "raise") -> DataFrame:
    """The key columns and, for a column of images: height, width, channels, NPY tiles, hash, in place of columns of those names."""
    small_batches(df.sparkSession)
    added = [("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("tiles", pa.list_(pa.binary())), ("dhash", pa.string())]
    keep = [f for f in df.schema.fields if f.name != column and f.name not in dict(added)]
    names = [f.name for f in keep]

    def one(data):
        try:
            image = decode(data or b"")
        except ValueError:
            if errors == "null":
                return (None,) * 5
            raise
        return (*image.shape[:2], image.shape[2] if image.ndim == 3 else 1, npy_tiles(image, tile), difference_hash(image))

    def run(batches):
        for batch in batches:
            found = [one(x.as_py()) for x in batch.column(column)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), *(pa.array([f[i] for f in found], t) for i, (_, t) in enumerate(added))], names=[*names, *(k for k, _ in added)])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + ["height int, width int, channels int, tiles array<binary>, dhash string"]
    return df.mapInArrow(run, ", ".join(schema))


def _store(batches, tile: int):
    for batch in batches:
        sizes, tiles = [], []
        for x in batch.column("data"):
            data = x.as_py()
            size = max(1, -(-len(data) // tile**2)) * tile**2
            samples = np.frombuffer(data.ljust(size, bytes([PAD])), np.uint8)
            sizes.append(len(data))
            tiles.append(npy_tiles(decode(encode_pgm(samples.reshape(-1, tile))), tile))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tiles, pa.list_(pa.binary()))], names=["doc_id", "n_bytes", "tiles"])


def store_texts(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """Each text's bytes as the samples of a grey PGM image, one tile wide, that is decoded and cut in NPY tiles; doc_id, n_bytes, tiles of a written table."""
    small_batches(docs.sparkSession)
    data = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("data"))
    return written(data.mapInArrow(lambda it: _store(it, tile), "doc_id long, n_bytes long, tiles array<binary>"), "tiles")


def _read(batches):
    added = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    for batch in batches:
        found = []
        for tiles in batch.column("tiles").to_pylist():
            image = np.concatenate(list(map(read_tile, tiles)))
            payload, media = image.tobytes(), b"".join(tiles)
            found.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), difference_hash(image)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array([f[i] for f in found], t) for i, (_, t) in enumerate(added))], names=["doc_id", "n_bytes", *(k for k, _ in added)])


def payload_features(stored: DataFrame) -> DataFrame:
    """What the stored tiles hold, read back from top to bottom: payload size and digest, checksum of its end, stored size and digest, difference hash."""
    small_batches(stored.sparkSession)
    return stored.mapInArrow(_read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
