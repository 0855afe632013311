"""Arrays as compressed binary values, for rows that hold a sorted run or a whole block."""

from __future__ import annotations

import functools

import numpy as np
import zstandard


@functools.cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Type and zstd of the values, byte planes one after the other; unsigned types as narrow as the values allow."""
    values = np.ascontiguousarray(values)
    if values.dtype.kind == "u" and len(values):
        values = values.astype(np.min_scalar_type(values.max()))
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return values.dtype.str.encode().ljust(4) + _codec()[0].compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    kind = np.dtype(blob[:4].decode().strip())
    planes = np.frombuffer(_codec()[1].decompress(blob[4:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def first_of(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours begins."""
    if not len(groups):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each (start, count), end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)
