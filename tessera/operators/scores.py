"""Scores of a block of queries against a block of sources as matrices, and the best of each query."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Queries and sources of one matrix.
ROWS, COLUMNS = 512, 4096


def matrix(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Lists as rows of a matrix, and their lengths; -1 for a null list or one with a null."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, n = lists.flatten(), len(lists)
    lengths = np.diff(lists.offsets.to_numpy())
    if n and not lists.null_count and not flat.null_count and (lengths == lengths[0]).all():
        return flat.to_numpy(zero_copy_only=False).astype(dtype).reshape(n, lengths[0]), lengths
    rows = [None if x is None or None in x else x for x in lists.to_pylist()]
    lengths = np.array([-1 if x is None else len(x) for x in rows], dtype=np.int64)
    out = np.zeros((n, max(0, lengths.max(initial=0))), dtype)
    for i, x in enumerate(rows):
        if x:
            out[i, : len(x)] = x
    return out, lengths


def _padded(values: np.ndarray, width: int) -> np.ndarray:
    return values if values.shape[1] == width else np.pad(values, ((0, 0), (0, width - values.shape[1])))


def _bits(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1).astype(np.float32)


def _both(q, s):
    """Two matrices of equal width, and where lengths are the same and known."""
    (a, n), (b, m) = q, s
    width = max(a.shape[1], b.shape[1])
    return _padded(a, width), _padded(b, width), (n[:, None] == m[None, :]) & (n[:, None] >= 0)


@dataclass(frozen=True)
class Tanimoto:
    """``neighbours.tanimoto`` of two columns of fingerprints, to the last bit."""

    q: str
    s: str

    def columns(self, side: str) -> list[tuple[str, type]]:
        return [(self.q if side == "q" else self.s, np.int64)]

    def __call__(self, q: list, s: list) -> np.ndarray:
        a, b, fit = _both(q[0], s[0])
        a, b = _bits(a), _bits(b)
        both = (a @ b.T).astype(np.float64)
        either = a.sum(axis=1, dtype=np.float64)[:, None] + b.sum(axis=1, dtype=np.float64)[None, :] - both
        out = np.divide(both, either, out=np.zeros_like(both), where=either > 0)
        return out if fit.all() else np.where(fit, out, 0.0)


@dataclass(frozen=True)
class WeightedTanimoto:
    """``neighbours.weighted_tanimoto`` of two pairs of columns; -1 where one is missing."""

    first: Tanimoto
    second: Tanimoto
    weights: tuple[float, float] = (0.8, 0.2)

    def columns(self, side: str) -> list[tuple[str, type]]:
        return self.first.columns(side) + self.second.columns(side)

    def __call__(self, q: list, s: list) -> np.ndarray:
        out = self.weights[0] * self.first(q[:1], s[:1]) + self.weights[1] * self.second(q[1:], s[1:])
        whole = lambda side: (side[0][1] >= 0) & (side[1][1] >= 0)
        return np.where(whole(q)[:, None] & whole(s)[None, :], out, -1.0)


@dataclass(frozen=True)
class Cosine:
    """``neighbours.cosine`` of two columns of vectors, to rounding; what has none comes last, what is no number first, as Spark orders them."""

    q: str
    s: str

    def columns(self, side: str) -> list[tuple[str, type]]:
        return [(self.q if side == "q" else self.s, np.float64)]

    def __call__(self, q: list, s: list) -> np.ndarray:
        a, b, fit = _both(q[0], s[0])
        with np.errstate(all="ignore"):
            norms = np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))[None, :]
            out = a @ b.T / norms
        out[np.isnan(out)] = np.inf
        out[(norms == 0) | ~fit] = -np.inf
        return out


def _first_copies(right: pa.Table, sides: list, ids: np.ndarray, k: int, modulus: int | None) -> np.ndarray:
    """Rows of sources, sorted by id, without those that follow k + 1 equal ones: such a row is among no query's k best."""
    if len(ids) <= k + 1:
        return np.arange(len(ids))
    parts = [np.ascontiguousarray(x).view(np.uint8).reshape(len(ids), -1) for v, n in sides for x in (v, n.astype(np.int64)[:, None])]
    parts.append(np.ascontiguousarray((ids % modulus if modulus else np.zeros_like(ids)).astype(np.int64)[:, None]).view(np.uint8))
    rows = np.ascontiguousarray(np.concatenate(parts, axis=1))
    _, kind = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_inverse=True)
    order = np.argsort(kind, kind="stable")
    starts = np.r_[0, np.flatnonzero(np.diff(kind[order])) + 1]
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return np.sort(order[place <= k])


def best(left: pa.Table, right: pa.Table, measure, k: int, apart, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of queries and of their ``k`` best sources (sorted by id; ties by it), and of those within ``margin`` of the k-th."""
    none = np.zeros(0, np.int64)
    if not left.num_rows or not right.num_rows or k < 1:
        return none, none
    q_ids, s_ids = left["q_id"].to_numpy(), right["s_id"].to_numpy()
    modulus, other = apart or (None, 0.0)
    asked = [matrix(left[c], t) for c, t in measure.columns("q")]
    held = [matrix(right[c], t) for c, t in measure.columns("s")]
    kept = _first_copies(right, held, s_ids, k, modulus)
    if apart and not modulus:
        # a query itself has a score of its own, and may come before its copies
        kept = np.union1d(kept, np.flatnonzero(np.isin(s_ids, q_ids)))
    cut = lambda sides, rows: [(v[rows], n[rows]) for v, n in sides]
    found = []
    for i in range(0, len(q_ids), ROWS):
        rows = np.arange(i, min(i + ROWS, len(q_ids)))
        q_side, bound = cut(asked, rows), np.full(len(rows), -np.inf)
        q, s, v = none, none, np.zeros(0)
        for j in range(0, len(kept), COLUMNS):
            at = kept[j : j + COLUMNS]
            m = measure(q_side, cut(held, at))
            if apart:
                a, b = q_ids[rows], s_ids[at]
                m[(a % modulus)[:, None] == (b % modulus)[None, :] if modulus else a[:, None] == b[None, :]] = other
            if len(at) >= k and not j:
                bound = np.partition(m, len(at) - k, axis=1)[:, len(at) - k]
            x, y = np.nonzero(m >= (bound - margin)[:, None])
            q, s, v = np.r_[q, x], np.r_[s, at[y]], np.r_[v, m[x, y]]
            order = np.lexsort((s, -v, q))
            q, s, v = q[order], s[order], v[order]
            starts = np.searchsorted(q, np.arange(len(rows)))
            sizes = np.diff(np.r_[starts, len(q)])
            place = np.arange(len(q)) - np.repeat(starts, sizes)
            full = sizes >= k
            bound = np.where(full, v[np.minimum(starts + k - 1, max(0, len(v) - 1))] if len(v) else -np.inf, -np.inf)
            keep = (place < k) | ((margin > 0) & (v >= bound[q] - margin))
            q, s, v = q[keep], s[keep], v[keep]
        found.append((rows[q], s))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
