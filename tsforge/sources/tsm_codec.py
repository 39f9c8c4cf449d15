"""Blocks of time-structured merge (TSM) files, version 1: encoders, and decoders of many blocks at a time.

A block is a type, the length of its times (a varint), the times and the values.
Times are deltas, scaled by a power of ten and packed in Simple-8b words, or one
run; integers are zig-zag deltas, packed likewise; floats are a stream of XORs;
booleans are bits; strings are lengths and bytes under Snappy. Decoders take the
words of all blocks together, or walk through the bit streams of many blocks in
lockstep, so that the work of a value is a few array operations.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Fixed values of the format.
MAGIC, VERSION = b"\x16\xd1\x16\xd1", 1
SEPARATOR = "#!~#"
KINDS = ("float64", "int64", "bool", "string", "uint64")
RAW, PACKED, RUN = 0, 1, 2
#: Values in a Simple-8b word, and bits of each, by selector; the first two are runs of ones.
PER_WORD = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
#: What ends a stream of floats.
END = 0x7FF8000000000001

_U = np.uint64
_SNAPPY = pa.Codec("snappy")


class TsmError(ValueError):
    """A file or block that is not in the format."""


# ---------------------------------------------------------------- small parts


def put_varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def varint(data: bytes, at: int) -> tuple[int, int]:
    """A varint and where it ends."""
    n = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise TsmError("a number that does not end")
        b = data[at]
        n |= (b & 0x7F) << shift
        at += 1
        if b < 0x80:
            return n, at
        shift += 7


def zigzag(deltas: np.ndarray) -> np.ndarray:
    return ((deltas << 1) ^ (deltas >> 63)).astype(np.int64).view(_U)


def unzigzag(words: np.ndarray) -> np.ndarray:
    return ((words >> _U(1)) ^ (~(words & _U(1)) + _U(1))).view(np.int64)


def _per_word(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The selector of a word that begins at each value, and may go on to where its part ends."""
    room = ends - np.arange(len(values))
    chosen = np.full(len(values), -1)
    for selector, (count, width) in enumerate(zip(PER_WORD, WIDTHS)):
        at = np.flatnonzero((chosen < 0) & (room >= count))
        if len(at):
            wide = np.r_[0, np.cumsum(values != _U(1) if width == 0 else values >= _U(1 << width))]
            at = at[wide[at + count] == wide[at]]
            chosen[at] = selector
    return chosen


def pack_all(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Simple-8b words (big-endian) of parts of values below 2**60, that lie one after another; ``sizes`` may be 0."""
    if (values >= _U(1 << 60)).any():
        raise TsmError("a value of more than 60 bits can't be packed")
    last = np.cumsum(sizes)
    selectors = _per_word(values, np.repeat(last, sizes))
    after = np.arange(len(values)) + np.array(PER_WORD)[selectors]
    at, end, found = (last - sizes)[sizes > 0], last[sizes > 0], []
    while len(at):  # a word of every part at a time
        found.append(at)
        at = after[at]
        at, end = at[at < end], end[at < end]
    starts = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
    own = selectors[starts]
    words = own.astype(_U) << _U(60)
    for selector in np.unique(own).tolist():
        if width := WIDTHS[selector]:
            mine, lanes = np.flatnonzero(own == selector), np.arange(PER_WORD[selector])
            words[mine] |= np.bitwise_or.reduce(values[starts[mine][:, None] + lanes] << (lanes * width).astype(_U), axis=1)
    return _cut(words.astype(">u8").tobytes(), np.searchsorted(starts, last) * 8)


def _cut(data: bytes, ends: np.ndarray) -> list[bytes]:
    ends = ends.tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def pack(values: np.ndarray) -> bytes:
    return pack_all(values, np.array([len(values)]))[0]


def unpack(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of words, one after another, and how many each word has."""
    selectors = (words >> _U(60)).astype(np.int64)
    counts = np.array(PER_WORD)[selectors]
    starts = np.cumsum(counts) - counts
    out = np.ones(int(counts.sum()), _U)
    for selector in np.unique(selectors).tolist():
        width = WIDTHS[selector]
        if width:
            own = np.flatnonzero(selectors == selector)
            lanes = np.arange(PER_WORD[selector])
            out[starts[own][:, None] + lanes] = (words[own][:, None] >> (lanes * width).astype(_U)) & _U((1 << width) - 1)
    return out, counts


def _unpack_all(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The values of several packed parts together, and how many each part has."""
    if any(len(p) % 8 for p in parts):
        raise TsmError("packed words are cut short")
    values, counts = unpack(np.frombuffer(b"".join(parts), ">u8").astype(_U))
    ends = np.cumsum([len(p) // 8 for p in parts])
    total = np.r_[0, np.cumsum(counts)]
    return values, np.diff(np.r_[0, total[ends]])


def _spread(first: np.ndarray, deltas: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Running sums: of each part its first value, and then the sums with its deltas (``counts`` of them); all modulo 2**64."""
    sizes = counts + 1
    starts = np.cumsum(sizes) - sizes
    steps = np.zeros(int(sizes.sum()), _U)
    inside = np.ones(len(steps), bool)
    inside[starts] = False
    steps[inside] = deltas
    sums = np.cumsum(steps, dtype=_U)
    return sums - np.repeat(sums[starts], sizes) + np.repeat(first, sizes)


def _ragged(parts: dict[int, np.ndarray], dtype) -> list[np.ndarray]:
    return [np.asarray(parts[i], dtype) for i in range(len(parts))]


def _split(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1])


# ---------------------------------------------------------------- times and integers


def _parts(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable]:
    """Where each part begins, how many of its values follow the first, and a function that tells if something holds for all of those."""
    starts, rest = np.cumsum(sizes) - sizes, sizes - 1
    ends = np.cumsum(rest)

    def every(holds: np.ndarray) -> np.ndarray:
        fails = np.r_[0, np.cumsum(~holds)]
        return fails[ends] == fails[ends - rest]

    return starts, rest, every


def encode_all_times(times: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Of blocks whose times lie one after another, ``sizes`` (1 at least) of each."""
    ts = np.asarray(times, np.int64).view(_U)
    starts, rest, every = _parts(ts, sizes)
    inside = np.ones(len(ts), bool)
    inside[starts] = False
    deltas = np.diff(ts, prepend=_U(0))[inside]
    scale = np.zeros(len(sizes), np.int64)
    for power in range(1, 13):
        even = (rest > 0) & every(deltas % _U(10**power) == 0)
        if not even.any():
            break
        scale += even
    firsts, ends = ts[starts].astype(">u8").tobytes(), np.cumsum(rest)
    head = deltas[np.minimum(ends - rest, max(len(deltas) - 1, 0))] if len(deltas) else np.zeros(len(sizes), _U)
    run = (rest > 0) & every(deltas == np.repeat(head, rest))
    raw = ~run & ~every(deltas < _U(1 << 60))
    plain = ~run & ~raw
    packed = iter(pack_all((deltas // np.repeat(_U(10) ** scale.astype(_U), rest))[np.repeat(plain, rest)], rest[plain]))
    out = []
    for i, (is_run, is_raw, s, delta, size) in enumerate(zip(run.tolist(), raw.tolist(), scale.tolist(), head.tolist(), sizes.tolist())):
        first = firsts[8 * i : 8 * i + 8]
        if is_run:
            out.append(bytes([RUN << 4 | s]) + first + put_varint(delta // 10**s) + put_varint(size))
        elif is_raw:
            out.append(bytes([RAW << 4]) + first + deltas[ends[i] - rest[i] : ends[i]].astype(">u8").tobytes())
        else:
            out.append(bytes([PACKED << 4 | s]) + first + next(packed))
    return out


def encode_times(times: np.ndarray) -> bytes:
    return encode_all_times(times, np.array([len(times)]))[0]


def _word(part: bytes) -> int:
    if len(part) < 9:
        raise TsmError("a block without a first value")
    return int.from_bytes(part[1:9], "big")


def decode_times(parts: list[bytes]) -> list[np.ndarray]:
    out: dict[int, np.ndarray] = {}
    packed = []
    for i, part in enumerate(parts):
        kind, scale = part[0] >> 4, 10 ** (part[0] & 15)
        if kind == PACKED:
            _word(part)
            packed.append(i)
        elif kind == RUN:
            delta, at = varint(part, 9)
            count, _ = varint(part, at)
            out[i] = (_U(_word(part)) + np.arange(count, dtype=_U) * _U(delta * scale % (1 << 64))).view(np.int64)
        elif kind == RAW:
            out[i] = np.cumsum(np.frombuffer(part[1:], ">u8").astype(_U), dtype=_U).view(np.int64)
        else:
            raise TsmError(f"unknown coding of times: {kind}")
    if packed:
        deltas, counts = _unpack_all([parts[i][9:] for i in packed])
        scales = np.repeat(np.array([10 ** (parts[i][0] & 15) for i in packed], _U), counts)
        sums = _spread(np.array([_word(parts[i]) for i in packed], _U), deltas * scales, counts)
        out |= dict(zip(packed, _split(sums.view(np.int64), counts + 1)))
    return _ragged(out, np.int64)


def encode_all_integers(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Of int64, or of uint64 by their bits; blocks as in ``encode_all_times``."""
    v = np.asarray(values)
    v = v.view(np.int64) if v.dtype == _U else v.astype(np.int64)
    starts, rest, every = _parts(v, sizes)
    before = np.r_[np.int64(0), v[:-1]]
    before[starts] = 0
    words = zigzag(v - before)
    inside = np.ones(len(v), bool)
    inside[starts] = False
    first, deltas, ends = words[starts], words[inside], np.cumsum(rest)
    head = deltas[np.minimum(ends - rest, max(len(deltas) - 1, 0))] if len(deltas) else np.zeros(len(sizes), _U)
    run = (rest > 1) & every(deltas == np.repeat(head, rest))
    raw = ~run & (~every(deltas < _U(1 << 60)) | (first >= _U(1 << 60)))
    plain = ~run & ~raw
    packed = iter(pack_all(deltas[np.repeat(plain, rest)], rest[plain]))
    firsts, out = first.astype(">u8").tobytes(), []
    for i, (is_run, is_raw, delta, size) in enumerate(zip(run.tolist(), raw.tolist(), head.tolist(), sizes.tolist())):
        if is_run:
            out.append(bytes([RUN << 4]) + firsts[8 * i : 8 * i + 8] + put_varint(delta) + put_varint(size - 1))
        elif is_raw:
            out.append(bytes([RAW << 4]) + words[starts[i] : starts[i] + size].astype(">u8").tobytes())
        else:
            out.append(bytes([PACKED << 4]) + firsts[8 * i : 8 * i + 8] + next(packed))
    return out


def encode_integers(values: np.ndarray) -> bytes:
    return encode_all_integers(values, np.array([len(values)]))[0]


def decode_integers(parts: list[bytes]) -> list[np.ndarray]:
    out: dict[int, np.ndarray] = {}
    packed = []
    for i, part in enumerate(parts):
        kind = part[0] >> 4
        if kind == PACKED:
            _word(part)
            packed.append(i)
        elif kind == RUN:
            delta, at = varint(part, 9)
            count, _ = varint(part, at)
            first, step = unzigzag(np.array([_word(part), delta], _U)).view(_U)
            out[i] = (first + np.arange(count + 1, dtype=_U) * step).view(np.int64)
        elif kind == RAW:
            out[i] = np.cumsum(unzigzag(np.frombuffer(part[1:], ">u8").astype(_U)).view(_U), dtype=_U).view(np.int64)
        else:
            raise TsmError(f"unknown coding of integers: {kind}")
    if packed:
        words, counts = _unpack_all([parts[i][9:] for i in packed])
        first = unzigzag(np.array([_word(parts[i]) for i in packed], _U)).view(_U)
        sums = _spread(first, unzigzag(words).view(_U), counts)
        out |= dict(zip(packed, _split(sums.view(np.int64), counts + 1)))
    return _ragged(out, np.int64)


# ---------------------------------------------------------------- floats


def _bit_length(x: np.ndarray) -> np.ndarray:
    high, low = (x >> _U(32)).astype(np.float64), (x & _U(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.int64)


def _windows(lead: list[int], trail: list[int], starts: set[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each XOR (``lead`` is 64 if it is 0) whether its window is new, and the window that it is written in."""
    fresh, leads, trails = [], [], []
    own_lead, own_trail = 65, 65
    for i, (a, b) in enumerate(zip(lead, trail)):
        if i in starts:
            own_lead, own_trail = 65, 65
        new = a < 64 and (a < own_lead or b < own_trail)
        if new:
            own_lead, own_trail = a, b
        fresh.append(new)
        leads.append(own_lead)
        trails.append(own_trail)
    return np.array(fresh, bool), np.array(leads, np.int64), np.array(trails, np.int64)


def _bits(codes: np.ndarray, widths: np.ndarray, items: np.ndarray) -> list[bytes]:
    """Codes of some bits (1 to 64) one after another, as the bytes of parts of ``items`` codes each."""
    ends = np.cumsum(items)
    total = np.r_[0, np.cumsum(widths)]
    bits = total[ends] - total[ends - items]
    room = (bits + 63) // 64
    first = np.cumsum(room) - room
    at = total[:-1] + np.repeat(first * 64 - total[ends - items], items)
    place, free = at >> 6, 64 - (at & 63)
    words = np.zeros(int(room.sum()), _U)
    over = widths - free  # bits that go on in the next word
    high = np.where(over > 0, codes >> np.maximum(over, 0).astype(_U), codes << np.maximum(-over, 0).astype(_U))
    group = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    words[place[group]] = np.bitwise_or.reduceat(high, group)
    on = np.flatnonzero(over > 0)
    words[place[on] + 1] |= codes[on] << (64 - over[on]).astype(_U)
    data = words.astype(">u8").tobytes()
    return [data[8 * a : 8 * a + (n + 7) // 8] for a, n in zip(first.tolist(), bits.tolist())]


def encode_all_floats(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Blocks as in ``encode_all_times``."""
    v = np.asarray(values, np.float64)
    if np.isnan(v).any():
        raise TsmError("no float that is not a number can be stored")
    ends = np.cumsum(sizes)
    own, following = v.view(_U), np.empty(len(v), _U)
    following[:-1] = own[1:]
    following[ends - 1] = END
    x = own ^ following
    length = _bit_length(x)
    lead = np.where(length == 0, 64, np.minimum(64 - length, 31))
    trail = np.where(length == 0, 64, _bit_length(x & (~x + _U(1))) - 1)
    fresh, lead, trail = _windows(lead.tolist(), trail.tolist(), set((ends - sizes).tolist()))
    size = np.where(length == 0, 0, 64 - lead - trail)
    control = np.where(fresh, 0b11 << 11 | lead << 6 | size & 63, np.where(length == 0, 0, 0b10)).astype(_U)
    payload = np.where(size > 0, x >> np.where(size > 0, trail, 0).astype(_U), _U(0))
    # a block's first value, and then a control and a payload for each XOR
    codes, widths = np.empty((len(v), 2), _U), np.empty((len(v), 2), np.int64)
    codes[:, 0], codes[:, 1] = control, payload
    widths[:, 0], widths[:, 1] = np.where(fresh, 13, np.where(length == 0, 1, 2)), size
    where = 2 * (ends - sizes)
    codes, widths = np.insert(codes.ravel(), where, own[ends - sizes]), np.insert(widths.ravel(), where, 64)
    some = widths > 0
    items = np.add.reduceat(some, where + np.arange(len(sizes))) if len(sizes) else sizes
    return [bytes([PACKED << 4]) + part for part in _bits(codes[some], widths[some], items)]


def encode_floats(values: np.ndarray) -> bytes:
    return encode_all_floats(values, np.array([len(values)]))[0]


def decode_floats(parts: list[bytes]) -> list[np.ndarray]:
    if any(p[0] >> 4 != PACKED for p in parts):
        raise TsmError("unknown coding of floats")
    room = 24
    data = np.frombuffer(b"".join(p[1:] + bytes(room) for p in parts), np.uint8)
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    sizes = np.array([len(p) - 1 + room for p in parts])
    starts = np.cumsum(sizes) - sizes
    ends = (starts + sizes - room) * 8

    def read(at: np.ndarray, width: np.ndarray) -> np.ndarray:
        """``width`` bits (0 to 64) from a bit on."""
        byte, shift = at >> 3, (at & 7).astype(_U)
        high = words[byte].astype(_U) << shift
        low = data[byte + 8].astype(_U) >> (_U(8) - shift)
        return np.where(width == 0, _U(0), (high | low) >> ((_U(64) - width.astype(_U)) % _U(64)))

    live = np.arange(len(parts))
    at = starts * 8
    if (at + 64 > ends).any():
        raise TsmError("a block without a first value")
    value = read(at, np.full(len(parts), 64))
    at = at + 64
    lead, trail = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    going = value != _U(END)
    while True:
        if not going.all():
            live, at, value, lead, trail = live[going], at[going], value[going], lead[going], trail[going]
        if not len(live):
            break
        found.append((live, value))
        if (at >= ends[live]).any():
            raise TsmError("a stream of floats that does not end")
        head = read(at, np.full(len(live), 13)).astype(np.int64)
        changed, fresh = head >> 12 == 1, head >> 11 == 3
        size = head & 63
        size = np.where(size == 0, 64, size)
        lead = np.where(fresh, head >> 6 & 31, lead)
        trail = np.where(fresh, 64 - lead - size, trail)
        if (trail < 0).any():
            raise TsmError("a stream of floats with a wrong width")
        width = np.where(changed, 64 - lead - trail, 0)
        at = at + np.where(fresh, 13, np.where(changed, 2, 1))
        value = value ^ (read(at, width) << trail.astype(_U))
        at = at + width
        going = value != _U(END)
    if not found:
        return [np.empty(0) for _ in parts]
    owner, bits = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    order = np.argsort(owner, kind="stable")
    return _split(bits[order].view(np.float64), np.bincount(owner, minlength=len(parts)))


# ---------------------------------------------------------------- booleans and strings


def encode_booleans(values: np.ndarray) -> bytes:
    return bytes([PACKED << 4]) + put_varint(len(values)) + np.packbits(np.asarray(values, bool)).tobytes()


def decode_booleans(parts: list[bytes]) -> list[np.ndarray]:
    out = []
    for part in parts:
        if part[0] >> 4 != PACKED:
            raise TsmError("unknown coding of booleans")
        count, at = varint(part, 1)
        bits = np.unpackbits(np.frombuffer(part[at:], np.uint8))
        if len(bits) < count:
            raise TsmError("bits are cut short")
        out.append(bits[:count].astype(bool))
    return out


_LENGTHS = [put_varint(n) for n in range(1 << 10)]


def encode_strings(values: list[str]) -> bytes:
    said = [v.encode("utf-8") for v in values]
    return bytes([PACKED << 4]) + _SNAPPY.compress(b"".join([x for s in said for x in (_LENGTHS[len(s)] if len(s) < 1 << 10 else put_varint(len(s)), s)]), asbytes=True)


def _each(encode_one: Callable) -> Callable:
    def run(values, sizes: np.ndarray) -> list[bytes]:
        ends = np.cumsum(sizes).tolist()
        return [encode_one(values[a:b]) for a, b in zip([0, *ends], ends)]

    return run


def decode_strings(parts: list[bytes]) -> list[list[str]]:
    out = []
    for part in parts:
        if part[0] >> 4 != PACKED:
            raise TsmError("unknown coding of strings")
        size, _ = varint(part, 1)
        data = _SNAPPY.decompress(part[1:], decompressed_size=size, asbytes=True)
        at, own = 0, []
        while at < len(data):
            n, at = varint(data, at)
            own.append(data[at : at + n].decode("utf-8"))
            at += n
        if at != len(data):
            raise TsmError("strings are cut short")
        out.append(own)
    return out


# ---------------------------------------------------------------- blocks

_ENCODE = {"float64": encode_all_floats, "int64": encode_all_integers, "uint64": encode_all_integers, "bool": _each(encode_booleans), "string": _each(encode_strings)}
_DECODE = {"float64": decode_floats, "int64": decode_integers, "uint64": decode_integers, "bool": decode_booleans, "string": decode_strings}


def encode_all(kind: str, times: np.ndarray, values, sizes: np.ndarray) -> list[bytes]:
    """Blocks of one type with their checksums, of times and values that lie one after another, ``sizes`` (1 at least) of each block."""
    out, head = [], bytes([KINDS.index(kind)])
    for stamps, said in zip(encode_all_times(times, sizes), _ENCODE[kind](values, sizes)):
        block = b"".join((head, put_varint(len(stamps)), stamps, said))
        out.append(zlib.crc32(block).to_bytes(4, "big") + block)
    return out


def encode(kind: str, times: np.ndarray, values) -> bytes:
    """A block with its checksum."""
    return encode_all(kind, times, values, np.array([len(times)]))[0]


def decode(kind: str, blocks: list[bytes]) -> list[tuple[np.ndarray, np.ndarray | list[str]]]:
    """Times and values of blocks (with their checksums) of one type."""
    stamps, values = [], []
    for block in blocks:
        if len(block) < 6 or zlib.crc32(block[4:]) != int.from_bytes(block[:4], "big"):
            raise TsmError("a block's checksum is wrong")
        if block[4] != KINDS.index(kind):
            raise TsmError("a block of another type than its index says")
        size, at = varint(block, 5)
        stamps.append(block[at : at + size])
        values.append(block[at + size :])
    if any(not s for s in stamps) or any(not v for v in values):
        raise TsmError("an empty block")
    times, found = decode_times(stamps), _DECODE[kind](values)
    if any(len(t) != len(v) for t, v in zip(times, found)):
        raise TsmError("a block has more times than values, or fewer")
    return list(zip(times, found))
