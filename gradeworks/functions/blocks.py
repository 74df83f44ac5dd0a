"""Distance kernels that run inside tasks on bounded blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Distances are rounded so that equal distances stay equal whatever block computed them.
DECIMALS = 9


# Entries of a distance table computed at a time, few enough to stay in the cache.
TABLE = 250_000


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of ``a`` to every row of ``b``, one row of the shorter at a time."""
    if len(a) > len(b):
        return distances(b, a, metric).T
    columns = np.ascontiguousarray(b.T)
    if len(a) * len(b) <= TABLE:
        # a small table is summed up column by column, in the same order
        out, gap = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
        for x, y in zip(np.ascontiguousarray(a.T), columns, strict=True):
            np.subtract(x[:, None], y, out=gap)
            out += np.abs(gap, out=gap) if metric == "manhattan" else np.multiply(gap, gap, out=gap)
        return np.round(out if metric == "manhattan" else np.sqrt(out), DECIMALS)
    out = np.empty((len(a), len(b)))
    for i, row in enumerate(a):
        gap = columns - row[:, None]
        out[i] = np.abs(gap).sum(axis=0) if metric == "manhattan" else np.sqrt((gap * gap).sum(axis=0))
    return np.round(out, DECIMALS)


def box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
    """How far every row is at least from what lies in each box [low, high]."""
    out = np.zeros((len(x), len(low)))
    for own, least, most in zip(np.ascontiguousarray(x.T)[:, :, None], np.ascontiguousarray(low.T), np.ascontiguousarray(high.T), strict=True):
        gap = np.maximum(least - own, own - most)
        np.maximum(gap, 0.0, out=gap)
        out += gap if metric == "manhattan" else np.multiply(gap, gap, out=gap)
    return out if metric == "manhattan" else np.sqrt(out)


def nearest(dist: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` smallest entries per row, ties by smaller id."""
    if dist.shape[1] > k:
        limit = np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
        rows, cols = np.nonzero(dist <= limit)
    else:
        rows, cols = np.nonzero(np.isfinite(dist))
    return _first(rows, cols, dist[rows, cols], ids, k)[:2]


def _first(rows: np.ndarray, cols: np.ndarray, dist: np.ndarray, ids: np.ndarray, k: int):
    """The ``k`` first candidates of every row by distance, then id."""
    order = np.lexsort((ids[cols], dist, rows))
    rows, cols, dist = rows[order], cols[order], dist[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], cols[keep], dist[keep]


@dataclass(frozen=True)
class Cuts:
    """A tree of cuts: a node's feature (-1 in a leaf), value, and first child, or the leaf's number; the second child is the next."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The number of every row's leaf; leaves of near numbers share most cuts."""
        node, open_ = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(open_):
            open_ = open_[self.feature[node[open_]] >= 0]
            at = node[open_]
            node[open_] = self.child[at] + (x[open_, self.feature[at]] > self.value[at])
        return self.child[node]


def cut_tree(x: np.ndarray, size: int) -> tuple[Cuts, list[np.ndarray]]:
    """Halve rows at the median of the feature of widest spread down to about ``size``; equal rows stay in one leaf."""
    feature, value, child = [-1], [0.0], [0]
    leaves, todo = [], [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        part = x[rows]
        if len(rows) > size:
            f = int(part.std(axis=0).argmax())
            column = part[:, f]
            cut = np.median(column)
            if cut >= column.max():
                below = column[column < cut]
                cut = below.max() if len(below) else cut
            low = column <= cut
            if low.any() and not low.all():
                feature[node], value[node], child[node] = f, float(cut), len(feature)
                feature += [-1, -1]
                value += [0.0, 0.0]
                child += [0, 0]
                todo += [(len(feature) - 1, rows[~low]), (len(feature) - 2, rows[low])]
                continue
        child[node] = len(leaves)
        leaves.append(rows)
    return Cuts(np.array(feature), np.array(value), np.array(child)), leaves


def nearest_rows(
    a: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int, metric: str, limits: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row of ``a``, row of ``b`` and distance for the ``k`` nearest, some rows of ``a`` at a time.

    With finite ``limits``, one per row of ``a``, farther rows may be left out.
    Euclidean candidates come from one matrix product. Its small error is covered by a
    margin, and the distances that decide are then computed plainly.
    """
    limited = limits is not None and bool(np.isfinite(limits).all())
    step = max(1, TABLE // max(1, len(b)))
    b_squares = (b * b).sum(axis=1)
    for start in range(0, len(a), step):
        part = a[start : start + step]
        if metric == "manhattan" or len(b) <= k:
            dist = distances(part, b, metric)
            if limited:
                rows, cols = np.nonzero(dist <= limits[start : start + step, None])
                rows, cols, near = _first(rows, cols, dist[rows, cols], ids, k)
                yield rows + start, cols, near
                continue
            rows, cols = nearest(dist, ids, k)
            yield rows + start, cols, dist[rows, cols]
            continue
        a_squares = (part * part).sum(axis=1)
        squares = a_squares[:, None] + b_squares[None, :] - 2.0 * (part @ b.T)
        margin = 1e-8 * (1.0 + a_squares + b_squares.max())
        if limited:
            limit = (limits[start : start + step] + 10.0**-DECIMALS) ** 2 + margin
        else:
            limit = np.partition(squares, k - 1, axis=1)[:, k - 1] + margin
        rows, cols = np.nonzero(squares <= limit[:, None])
        dist = np.empty(len(rows))
        slice_ = max(1, 4 * TABLE // b.shape[1])
        for i in range(0, len(rows), slice_):
            gap = b[cols[i : i + slice_]] - part[rows[i : i + slice_]]
            dist[i : i + slice_] = np.sqrt((gap * gap).sum(axis=1))
        rows, cols, dist = _first(rows, cols, np.round(dist, DECIMALS), ids, k)
        yield rows + start, cols, dist


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list<double> column as a rows x width array, nulls as NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, width)
