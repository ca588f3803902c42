"""What a neighbour search in few dimensions needs: a tree of cells over a table, and small trees inside a cell.

A cell tree is cut from a sample of the rows and deals all of them out; every node knows the box of its rows, so a query finds
the cells within its bound by going down from the root, not by looking at all cells. Inside a cell, queries and rows are cut
into small groups whose boxes tell which of them must be compared; :func:`neighbors.block_top` compares them. Boxes only leave
out what cannot matter, so answers are exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np

from riskloom.operators.neighbors import SLACK, block_top

LEAF = 256  # rows of a group inside a cell
FEW, MANY = 32, 6  # queries that are not parted any more, and groups whose rows ask for parting them
FRONTIER = 1 << 19  # (query, node) pairs looked at together


def _gaps(under: np.ndarray, over: np.ndarray, metric: str) -> np.ndarray:
    """Length of the way from a point or box to a box, from what it lies below and above it in every dimension."""
    gap = np.maximum(np.maximum(under, over), 0)
    return (gap.sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))) * (1 - SLACK)


def _wider(bound: np.ndarray) -> np.ndarray:
    return bound + SLACK * (1 + np.abs(bound))


class CellTree:
    """Nodes with a feature and a cut (rows up to it go left); a leaf has feature -1 and a cell."""

    def __init__(self, feature: list, cut: list, left: list, right: list, cell: list):
        self.feature, self.left, self.right, self.cell = (np.array(v, dtype=np.int64) for v in (feature, left, right, cell))
        self.cut = np.array(cut, dtype=float)
        self.low = self.high = None

    @classmethod
    def grow(cls, sample: np.ndarray, many: int) -> tuple[CellTree, np.ndarray]:
        """A tree of at most ``many`` cells, the node with most of the sample cut first; and a sampled row of every cell."""
        feature, cut, left, right, rows = [-1], [0.0], [-1], [-1], {0: np.arange(len(sample))}
        queue, leaves = [(-len(sample), 0)], 1
        while queue and leaves < many:
            _, node = heapq.heappop(queue)
            found = _cut(sample[rows[node]])
            if found is None:
                continue
            j, at = found
            mine, leaves = rows.pop(node), leaves + 1
            feature[node], cut[node], left[node], right[node] = j, at, len(feature), len(feature) + 1
            goes_right = sample[mine, j] > at
            for part in (mine[~goes_right], mine[goes_right]):
                rows[len(feature)] = part
                heapq.heappush(queue, (-len(part), len(feature)))
                for values, v in ((feature, -1), (cut, 0.0), (left, -1), (right, -1)):
                    values.append(v)
        cell = [-1] * len(feature)
        for c, node in enumerate(sorted(rows)):
            cell[node] = c
        return cls(feature, cut, left, right, cell), np.array([sample[rows[node][0]] for node in sorted(rows)])

    def ways(self) -> list[list[tuple[int, float, int]]]:
        """Per cell the cuts from the root to it: (feature, cut, 1 where it lies above the cut)."""
        out: list = [None] * (int(self.cell.max()) + 1)
        todo: list = [(0, [])]
        while todo:
            node, way = todo.pop()
            if self.feature[node] < 0:
                out[self.cell[node]] = way
            else:
                step = int(self.feature[node]), float(self.cut[node])
                todo += [(self.left[node], [*way, (*step, 0)]), (self.right[node], [*way, (*step, 1)])]
        return out

    @classmethod
    def from_ways(cls, ways: Sequence[Sequence]) -> CellTree:
        feature, cut, left, right, cell = [-1], [0.0], [-1], [-1], [-1]
        for c, way in enumerate(ways):
            node = 0
            for j, at, side in way:
                if feature[node] < 0:
                    feature[node], cut[node], left[node], right[node] = j, at, len(feature), len(feature) + 1
                    for values, v in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (cell, -1)):
                        values += [v, v]
                node = right[node] if side else left[node]
            cell[node] = c
        return cls(feature, cut, left, right, cell)

    def with_boxes(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> CellTree:
        """Boxes of all nodes from those of the cells; children are made after their parents."""
        shape = (len(self.feature), low.shape[1])
        self.low, self.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        for node in reversed(range(len(self.feature))):
            if self.feature[node] >= 0:
                a, b = self.left[node], self.right[node]
                self.low[node], self.high[node] = np.minimum(self.low[a], self.low[b]), np.maximum(self.high[a], self.high[b])
            elif size[self.cell[node]] > 0:
                self.low[node], self.high[node] = low[self.cell[node]], high[self.cell[node]]
        return self

    def home(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row."""
        node, open_ = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(open_):
            open_ = open_[self.feature[node[open_]] >= 0]
            at = node[open_]
            node[open_] = np.where(x[open_, self.feature[at]] > self.cut[at], self.right[at], self.left[at])
        return self.cell[node]

    def within(self, x: np.ndarray, bound: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells whose box reaches into the bound of a row, in the order of rows."""
        limit = _wider(bound)
        query, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        while len(query):
            if len(query) > FRONTIER and len(x) > 1:
                half = len(x) // 2
                a, b = self.within(x[:half], bound[:half], metric), self.within(x[half:], bound[half:], metric)
                return np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]])
            near = _gaps(self.low[node] - x[query], x[query] - self.high[node], metric) <= limit[query]
            query, node = query[near], node[near]
            leaf = self.feature[node] < 0
            found.append((query[leaf], self.cell[node[leaf]]))
            query, node = query[~leaf], node[~leaf]
            query, node = np.concatenate([query, query]), np.concatenate([self.left[node], self.right[node]])
        row, cell = (np.concatenate(v) for v in zip(*found))
        order = np.lexsort((cell, row))
        return row[order], cell[order]


def _cut(x: np.ndarray) -> tuple[int, float] | None:
    """(feature, cut) in the middle of the widest dimension, or at its median where the middle leaves less than a tenth on a side."""
    if len(x) < 2:
        return None
    low, high = x.min(0), x.max(0)
    j = int(np.argmax(high - low))
    if not high[j] > low[j] or not np.isfinite(high[j] - low[j]):
        return None
    v, at = x[:, j], low[j] + (high[j] - low[j]) / 2
    if not 0.1 <= (v <= at).mean() <= 0.9:
        at = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
    if not at < high[j]:
        at = v[v < high[j]].max()
    return j, float(at)


def _groups(x: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows in groups of at most ``most`` (more only where all are equal), and the groups' boxes."""
    out, low, high, todo = [], [], [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        part = x[rows]
        found = _cut(part) if len(rows) > most else None
        if found is None:
            out.append(rows)
            low.append(part.min(0))
            high.append(part.max(0))
        else:
            goes_right = part[:, found[0]] > found[1]
            todo += [rows[goes_right], rows[~goes_right]]
    return out, np.array(low), np.array(high)


def first_copies(x: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows that fewer than ``most`` equal rows come before, rising."""
    _, same = np.unique(_whole(x), return_inverse=True)
    order = np.argsort(same, kind="stable")
    first = np.searchsorted(same[order], np.arange(len(x)))
    return np.sort(order[np.arange(len(x)) - first[same[order]] < most])


def _whole(x: np.ndarray) -> np.ndarray:
    """Every row as one value; zeros of both signs are one."""
    return np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()


def cell_top(a: np.ndarray, b: np.ndarray, k: int, metric: str, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``block_top`` finds, by comparing groups of near rows only; equal rows of ``a`` share an answer."""
    held = first_copies(b, k)
    _, first, same = np.unique(np.hstack([_whole(a)[:, None].view(np.uint8).reshape(len(a), -1), bound[:, None].view(np.uint8).reshape(len(a), -1)]).view(np.dtype((np.void, a.shape[1] * 8 + 8))).ravel(), return_index=True, return_inverse=True)
    row, col, dist = _grouped_top(a[first], b[held], k, metric, bound[first])
    # A distinct row's answers lie together.
    start, many = np.searchsorted(row, np.arange(len(first))), np.bincount(row, minlength=len(first))
    times = many[same]
    at = np.repeat(start[same] - np.cumsum(times) + times, times) + np.arange(times.sum())
    return np.repeat(np.arange(len(a)), times), held[col[at]], dist[at]


def _grouped_top(a: np.ndarray, b: np.ndarray, k: int, metric: str, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(b) <= 4 * LEAF:
        return block_top(a, b, k, metric, bound=bound)
    leaves, low, high = _groups(b, LEAF)
    size = np.array([len(r) for r in leaves])
    found = []
    for rows, start, end in zip(*_groups(a, LEAF)):
        x, limit = a[rows], bound[rows]
        gap = _gaps(low - end, start - high, metric)
        got = None
        if not np.isfinite(limit).all():
            # The nearest groups bound the k-th distance.
            middle = _gaps(low - (start + end) / 2, (start + end) / 2 - high, metric)
            order = np.lexsort((middle, gap))
            some = order[: int(np.searchsorted(np.cumsum(size[order]), max(k, 2 * LEAF))) + 1]
            at = np.sort(np.concatenate([leaves[i] for i in some]))
            got = block_top(x, b[at], k, metric, bound=limit)
            full = np.flatnonzero(np.bincount(got[0], minlength=len(x)) >= k)
            limit = limit.copy()
            limit[full] = got[2][np.searchsorted(got[0], full) + k - 1]
        wanted = gap <= _wider(limit).max()
        if got is not None and wanted.sum() == wanted[some].sum():
            found.append((rows[got[0]], at[got[1]], got[2]))
            continue
        todo = [np.arange(len(x))]
        while todo:
            mine = todo.pop()
            gap = _gaps(low - x[mine].max(0), x[mine].min(0) - high, metric)
            wanted = gap <= _wider(limit[mine]).max()
            if len(mine) > FEW and size[wanted].sum() > MANY * LEAF:
                # Rows of wide bounds go apart, so that the others need not look as far.
                order, half = np.argsort(limit[mine]), len(mine) // 2
                todo += [mine[order[:half]], mine[order[half:]]]
            elif wanted.any():
                at = np.sort(np.concatenate([leaves[i] for i in np.flatnonzero(wanted)]))
                got = block_top(x[mine], b[at], k, metric, bound=limit[mine])
                found.append((rows[mine[got[0]]], at[got[1]], got[2]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    row, col, dist = (np.concatenate(v) for v in zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], col[order], dist[order]
