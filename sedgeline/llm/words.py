"""Vectorised words of Arrow string columns: 64-bit hashes by a polynomial over table-mapped bytes, a few array steps per byte.

Equal words have equal hashes everywhere; unequal ones collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_B = 0x9E3779B97F4A7C15 | 1
_BINV = pow(_B, -1, 1 << 64)
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_MAP = mix(np.arange(1, 257, dtype=U) * U(_B))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, 1 << max(n, 1).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            both = []
            for base in (_B, _BINV):
                p = np.full(size, U(base))
                p[0] = 1
                both.append(np.cumprod(p))
        _powers[size] = tuple(both)
    return _powers[size]


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _MAP) -> np.ndarray:
    """The hash of each stretch of bytes; bytes that `table` maps to 0 do not count."""
    with np.errstate(over="ignore"):
        p, inv = _power(len(data))
        run = np.zeros(len(data) + 1, U)
        np.cumsum(table[data] * p[: len(data)], out=run[1:])
        return mix((run[ends] - run[starts]) * inv[starts])


def split(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie end to end, and the number of words of each text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    on = ~space[data]
    first = on.copy()
    first[1:] &= ~on[:-1]
    edges = offsets[(offsets < len(data))]
    first[edges] = on[edges]
    last = on.copy()
    last[:-1] &= ~on[1:]
    edges = offsets[offsets > 0] - 1
    last[edges] = on[edges]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of together at most so many bytes; a longer text is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b
