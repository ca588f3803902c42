"""Merge tables of byte-pair vocabularies and the numpy rounds that apply them.

A vocabulary gives each symbol an id and each symbol that can be made by a merge a rank. A sequence of
symbols is merged by taking, again and again, the leftmost of its pairs with the lowest rank. Both forms below do
exactly that for many sequences at once; sequences longer than ``LONG`` symbols take a heap instead, because one
merge a round would cost time in the square of their length.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Sequences with more symbols than this are merged with a heap; the result is the same.
LONG = 256
NO_RANK = np.int64(1 << 60)
_FREE = np.int64(-1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> (rank, merged id) as an open-addressing hash table in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(key)) * 4))))
        size = 1 << self.bits
        self.mask = size - 1
        self.keys = np.full(size, _FREE)
        self.ranks = np.full(size, NO_RANK)
        self.merged = np.full(size, -1, dtype=np.int64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            at = slot[todo]
            free = self.keys[at] == _FREE
            first = np.zeros(len(todo), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            win = free & first
            self.keys[at[win]] = key[todo[win]]
            self.ranks[at[win]] = rank[todo[win]]
            self.merged[at[win]] = merged[todo[win]]
            todo = todo[~win]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; ``NO_RANK`` where the pair is not mergeable."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self._slot(key)
        seen = self.keys[at]
        rank = np.where(seen == key, self.ranks[at], NO_RANK)
        merged = np.where(seen == key, self.merged[at], -1)
        todo = np.flatnonzero((seen != key) & (seen != _FREE))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            seen = self.keys[at[todo]]
            hit = seen == key[todo]
            rank[todo[hit]] = self.ranks[at[todo[hit]]]
            merged[todo[hit]] = self.merged[at[todo[hit]]]
            todo = todo[~hit & (seen != _FREE)]
        return rank, merged

    def one(self, left: int, right: int) -> tuple[int, int]:
        rank, merged = self.find(np.array([left]), np.array([right]))
        return int(rank[0]), int(merged[0])


def merge_long(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """One sequence by a heap of its pairs, ordered by (rank, position)."""
    ids = [int(x) for x in symbols]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def pair(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in known:
            known[a, b] = table.one(a, b)
        return known[a, b]

    rank, merged = table.find(symbols[:-1], symbols[1:])
    heap = [(int(r), i, ids[i], ids[i + 1], int(m)) for i, (r, m) in enumerate(zip(rank, merged, strict=True)) if r < NO_RANK]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = m, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n:
                r, made = pair(ids[x], ids[y])
                if r < NO_RANK:
                    heapq.heappush(heap, (r, x, ids[x], ids[y], made))
    return np.array([x for x in ids if x >= 0], dtype=np.int64)


def merge_ragged(ids: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge ragged sequences (``ids`` laid end to end, ``lengths`` symbols each, none empty), rank-synchronously.

    Every round finds each sequence's lowest rank with one segmented minimum and applies the leftmost pair that has
    it, in all sequences at the same time. Finished sequences leave the working arrays.
    Returns the surviving symbols laid end to end, and how many each sequence has.
    """
    count = len(lengths)
    out: list[np.ndarray | None] = [None] * count
    left = np.repeat(lengths <= LONG, lengths)
    start = np.concatenate(([0], np.cumsum(lengths)))
    for s in np.flatnonzero(lengths > LONG):
        out[s] = merge_long(ids[start[s] : start[s + 1]], table)
    order = np.flatnonzero(lengths <= LONG)
    flat, sizes = ids[left].astype(np.int64), lengths[order].astype(np.int64)
    done_ids, done_seq, done_size = [], [], []
    owner = np.repeat(np.arange(len(order)), sizes)

    def ranks(a: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return table.find(a[where], a[where + 1])

    rank, made = np.full(len(flat), NO_RANK), np.full(len(flat), -1, dtype=np.int64)
    inner = np.flatnonzero(owner[:-1] == owner[1:]) if len(flat) else np.zeros(0, dtype=np.int64)
    rank[inner], made[inner] = ranks(flat, inner)
    while len(sizes):
        first = np.cumsum(sizes) - sizes
        low = np.minimum.reduceat(rank, first)
        over = low == NO_RANK
        if over.any():
            gone = np.repeat(over, sizes)
            done_ids.append(flat[gone])
            done_seq.append(order[over])
            done_size.append(sizes[over])
            flat, rank, made, low = flat[~gone], rank[~gone], made[~gone], low[~over]
            order, sizes = order[~over], sizes[~over]
            if not len(sizes):
                break
            first = np.cumsum(sizes) - sizes
        hits = np.flatnonzero(rank == np.repeat(low, sizes))
        row = np.searchsorted(first, hits, side="right") - 1
        at = hits[np.concatenate(([True], row[1:] != row[:-1]))]
        flat[at] = made[at]
        keep = np.ones(len(flat), dtype=bool)
        keep[at + 1] = False
        rank[at], made[at] = NO_RANK, -1
        flat, rank, made = flat[keep], rank[keep], made[keep]
        sizes = sizes - 1
        at = at - np.arange(len(at))  # one symbol left the array in every earlier sequence
        first = np.cumsum(sizes) - sizes
        last = first + sizes - 1
        right = at[at < last]
        rank[right], made[right] = ranks(flat, right)
        before = at[at > first] - 1
        rank[before], made[before] = ranks(flat, before)
    sizes_out = np.zeros(count, dtype=np.int64)
    for seq, size in zip(done_seq, done_size, strict=True):
        sizes_out[seq] = size
    for s in range(count):
        if out[s] is not None:
            sizes_out[s] = len(out[s])
    result = np.empty(int(sizes_out.sum()), dtype=np.int64)
    begin = np.cumsum(sizes_out) - sizes_out
    for part, seq, size in zip(done_ids, done_seq, done_size, strict=True):
        inside = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size)
        result[np.repeat(begin[seq], size) + inside] = part
    for s in range(count):
        if out[s] is not None:
            result[begin[s] : begin[s] + sizes_out[s]] = out[s]
    return result, sizes_out


def merge_padded(rows: np.ndarray, sizes: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge a padded matrix of sequences of similar length: every round merges each row's leftmost minimum-rank pair.

    ``rows`` is n x width with -1 behind each row's ``sizes`` symbols. Rows without a pair left are compacted away.
    Returns the matrix with the surviving symbols in front, and how many each row has.
    """
    rows, sizes = rows.copy(), sizes.copy()
    n, width = rows.shape
    if width < 2:
        return rows, sizes
    live = np.arange(n)
    work = rows
    rank, made = table.find(work[:, :-1].ravel(), work[:, 1:].ravel())
    rank, made = rank.reshape(n, width - 1), made.reshape(n, width - 1)
    padding = work[:, 1:] < 0
    rank[padding] = NO_RANK
    while True:
        at = rank.argmin(axis=1)
        mine = np.arange(len(live))
        going = rank[mine, at] < NO_RANK
        if not going.all():
            stop = ~going
            rows[live[stop], : work.shape[1]] = work[stop]
            rows[live[stop], work.shape[1] :] = -1
            live, work, rank, made, at = live[going], work[going], rank[going], made[going], at[going]
            if not len(live):
                return rows, sizes
            mine = np.arange(len(live))
        work[mine, at] = made[mine, at]
        sizes[live] -= 1
        # Close the gap behind each merged pair; the last column falls away.
        columns = np.arange(work.shape[1] - 1)
        work = np.take_along_axis(work, columns + (columns > at[:, None]), axis=1)
        columns = np.arange(rank.shape[1] - 1)
        shift = columns + (columns > at[:, None])
        rank, made = np.take_along_axis(rank, shift, axis=1), np.take_along_axis(made, shift, axis=1)
        if not rank.shape[1]:
            rows[live, : work.shape[1]] = work
            rows[live, work.shape[1] :] = -1
            return rows, sizes
        for where, ok in ((at, at < sizes[live] - 1), (at - 1, at > 0)):
            r, c = mine[ok], where[ok]
            rank[r, c], made[r, c] = table.find(work[r, c], work[r, c + 1])
        ends = at >= sizes[live] - 1
        ends &= at < rank.shape[1]
        rank[mine[ends], at[ends]] = NO_RANK
