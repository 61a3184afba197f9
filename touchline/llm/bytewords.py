"""Vectorised words of a batch of texts: boundaries and 64-bit hashes over the raw UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Separators of words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes hashed at once; a longer text is hashed whole.
PIECE = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SEP = np.zeros(256, bool)
_SEP[list(BLANKS)] = True
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", _BACK)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a string column; a null text is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(off: np.ndarray):
    """(first, last) text numbers of runs of about PIECE bytes."""
    first = 0
    while first < len(off) - 1:
        last = int(np.searchsorted(off, off[first] + PIECE, "right")) - 1
        last = min(max(last, first + 1), len(off) - 1)
        yield first, last
        first = last


def word_hashes(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, length, hash) of every word of the texts raw[off[i]:off[i+1]]."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~_SEP[raw]
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up, out=total[1:])
    length = ends - starts
    h = mix((total[ends] - total[starts]) * down[starts] + length.astype(np.uint64))
    return np.searchsorted(off, starts, "right") - 1, length, h
