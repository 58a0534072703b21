"""Words and their hashes for whole Arrow batches, as numpy operations on the text's bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about so many bytes, so that the arrays beside them stay small.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = 0xD1342543DE82EF95
_up = _down = np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """Another scramble of the same integers for each ``salt``."""
    return mix(x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    global _up, _down
    if len(_up) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _up, _down = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(size - 1, x, np.uint64))) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _up, _down


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with empty strings for nulls, with 64-bit offsets."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (and the last ends)."""
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows of about ``limit`` bytes each (at least one row), with the number of their first."""
    _, starts = raw_bytes(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
        yield at, texts.slice(at, end - at)
        at = end


def spans_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between the ASCII white space of texts: first byte, end and the text's number.

    ``bounds`` are the offsets of the texts in ``data``; a word never spans two texts.
    """
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    word = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(bounds, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span: a polynomial of its bytes, from running sums, mixed with its length.

    Spans must be in order. With ``lower`` the letters A-Z count as a-z.
    """
    out, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        first = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, first + 2 * SLICE_BYTES, "right")))
        held = data[first : ends[to - 1]]
        up, down = _powers(len(held) + 1)
        total = np.zeros(len(held) + 1, np.uint64)
        values = (_LOWER[held] if lower else held).astype(np.uint64)
        values += np.uint64(1)
        values *= up[: len(held)]
        np.cumsum(values, out=total[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        out[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, in order, and the number of its text."""
    data, bounds = raw_bytes(texts)
    starts, ends, owner = spans_of(data, bounds)
    return span_hashes(data, starts, ends, lower), owner


def runs(owner: np.ndarray, n: int) -> np.ndarray:
    """Bounds of each text's words in ``owner``, an ascending array: n + 1 numbers."""
    return np.searchsorted(owner, np.arange(n + 1))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of ``values`` between each two bounds; 0 where there are none. 64-bit integers wrap."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), values.dtype)
    if len(values):
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        if len(full):
            out[full] = np.add.reduceat(values, bounds[full], axis=0)
    return out
