"""Golomb-Rice coding of sorted 64-bit fingerprints.

A sorted list of ``n`` hashes in a range of ``2**width`` has gaps of about
``2**width / n``. Each gap is split at ``rice`` bits: the quotient in unary
(a run of zeros and a one), the remainder in ``rice`` plain bits.
"""

from __future__ import annotations

import numpy as np

_SLICE = 1 << 18


def rice_parameter(n: int, width: int) -> int:
    """The power of two next below the mean gap."""
    return max(0, width - max(1, int(n)).bit_length()) if n else 0


def encode(values: np.ndarray, rice: int) -> bytes:
    """Ascending uint64 values, relative to the start of their range, as bytes."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    quotient = (gaps >> np.uint64(rice)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + len(values), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    head = np.packbits(unary).tobytes()
    tail = []
    shifts = np.arange(rice - 1, -1, -1, dtype=np.uint64)
    for at in range(0, len(gaps), _SLICE):
        part = gaps[at : at + _SLICE, None]
        tail.append(np.packbits(((part >> shifts) & np.uint64(1)).astype(np.uint8)).tobytes())
    return len(head).to_bytes(8, "little") + head + b"".join(tail)


def decode(data: bytes, n: int, rice: int) -> np.ndarray:
    """The ``n`` values that ``encode`` was given."""
    if not n:
        return np.zeros(0, np.uint64)
    size = int.from_bytes(data[:8], "little")
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, 8)))[:n]
    quotient = np.diff(ones, prepend=-1) - 1
    gaps = quotient.astype(np.uint64) << np.uint64(rice)
    if rice:
        at = 8 + size
        weights = np.uint64(1) << np.arange(rice - 1, -1, -1, dtype=np.uint64)
        for first in range(0, n, _SLICE):
            count = min(_SLICE, n - first)
            used = (count * rice + 7) // 8
            bits = np.unpackbits(np.frombuffer(data, np.uint8, used, at))[: count * rice]
            gaps[first : first + count] |= bits.reshape(count, rice).astype(np.uint64) @ weights
            at += used
    return np.cumsum(gaps, dtype=np.uint64)
