"""Vectorised words, lines and window hashes over blocks of UTF-8 text.

A block is the bytes of several texts laid end to end. Everything is computed for
the whole block at once with numpy; ``blocks`` keeps blocks small, so memory does
not depend on the number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n - 1, 0), _MULTIPLIER))])


def blocks(texts: list[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes; a longer text is a range of its own."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


@dataclass
class Pieces:
    """Words or lines of a block: first byte, byte after the last, text number, 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins (one more entry for the end)."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), bounds


def _pieces(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray, table: np.ndarray) -> Pieces:
    inside = ~separator
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    begins = inside.copy()
    begins[1:] &= separator[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= separator[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(start):
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none, np.zeros(0, np.uint64))
    length = end - start
    position = np.flatnonzero(inside)
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)[:-1]])
    power = powers(int(length.max()))
    weights = table[data[position]] * power[position - np.repeat(start, length)]
    hashed = mix(np.add.reduceat(weights, offsets) ^ (length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return Pieces(start, end, np.searchsorted(bounds, start, side="right") - 1, hashed)


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> Pieces:
    """Maximal runs of bytes other than space and 0x09-0x0D; never across texts."""
    return _pieces(data, bounds, _SPACE[data], _BYTE_LOWER if lower else _BYTE)


def lines(data: np.ndarray, bounds: np.ndarray) -> Pieces:
    """Non-empty runs between newlines (empty lines hold no word and are left out)."""
    return _pieces(data, bounds, data == 0x0A, _BYTE)


def windows(piece: Pieces, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n pieces from each index on, and whether they lie in one text."""
    count = len(piece.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    power = powers(n)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += piece.hash[k : k + count] * power[k]
    return mix(total), piece.text[:count] == piece.text[n - 1 :]


def spread(mask: np.ndarray, n: int, size: int) -> np.ndarray:
    """Elements covered by windows of n elements whose starts are marked."""
    at = np.flatnonzero(mask)
    change = np.bincount(at, minlength=size + 1) - np.bincount(at + n, minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def repeated_in_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which entries have the same key as another entry of the same text."""
    joint = mix(keys + mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(joint, kind="stable")
    ranked = joint[order]
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = ranked[1:] == ranked[:-1]
        same[1:] |= equal
        same[:-1] |= equal
    out = np.empty(len(keys), bool)
    out[order] = same
    return out


def encoded(column) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null as empty."""
    return [b"" if t is None else t.encode() for t in column.to_pylist()]
