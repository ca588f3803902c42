"""Trees grown from histograms: level by level or best leaf first, by impurity or by second-order gain, with pruning.

Rows are binned once and stored, one byte per feature. A pass over them finds each row's node by walking the tree so far and counts
(node, feature, bin) cells inside the task; the cells are summed, and the best split of every node is chosen by window sums over
the cells. All open nodes of all trees share a pass, so a forest takes as many passes as its deepest tree has levels,
and the rows are never shuffled or rewritten. Of two siblings only the smaller one is counted; the other is the parent less its
sibling, in the same grouped sum.

The driver holds nodes, one best split each, never cells or rows. A pass counts at most ``CELLS`` cells, more nodes take more
passes. A tree stops at ``MAX_NODES`` nodes with an error, because the tasks walk it in memory.

Boosting asks for many trees, one after another. Rows of equal bins, label and weight always have equal margins and gradients, so
where a table has at most ``PATTERNS`` such patterns, the tasks only count how often each tree's draw takes each pattern, many trees
in a pass, and the sequence is grown over the patterns. Other tables take a pass per level of every tree.

Random choices (bootstrap counts, row and feature shares) are digests of row keys, tree and node numbers, so a task that is run again
after a lost executor gives the same cells.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.ordering import exact_quantiles
from riskloom.operators.features import _Columns
from riskloom.runtime import collect_bounded, materialize

CELLS = 1 << 21  # cells one task counts at once
MAX_NODES = 1 << 22
STORE_EVERY = 8  # boosted trees between two stored margins
PATTERNS = 1 << 16  # different rows up to which boosting grows over patterns
TALLIES = 1 << 20  # counts of (tree, pattern) brought to the driver at once
TALLY_ROWS = 1 << 18  # rows counted together
SCORES = 1 << 20  # combinations of bins up to which a scoring task keeps what it has summed


@dataclass(frozen=True)
class Rules:
    """When a node is split, and how good a split is.

    ``criterion`` is gini, entropy or second_order. ``max_leaves`` turns growth into best leaf first. Depth has no limit where ``max_depth`` is
    None. ``max_features`` (None, sqrt, log2, a number or a share) draws the features of every node anew.
    """

    criterion: str = "gini"
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_leaves: int | None = None
    max_features: str | int | float | None = None
    min_child_weight: float = 0.0
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    gamma: float = 0.0

    def __post_init__(self):
        if self.criterion not in ("gini", "entropy", "second_order"):
            raise ValueError(f"unknown criterion {self.criterion}")
        if self.max_depth is not None and self.max_depth < 1:
            raise ValueError("max_depth must be at least 1")
        if self.max_leaves is not None and self.max_leaves < 2:
            raise ValueError("max_leaves must be at least 2")

    def features_of(self, width: int) -> int | None:
        many = self.max_features
        if many in (None, "all"):
            return None
        if many in ("sqrt", "log2"):
            many = math.sqrt(width) if many == "sqrt" else math.log2(width)
        elif isinstance(many, float):
            many = many * width
        return min(width, max(1, int(many)))


def soft(g, alpha: float):
    """Gradient sum shrunk by the L1 penalty; for numbers and columns."""
    if isinstance(g, Column):
        return F.signum(g) * F.greatest(F.abs(g) - F.lit(alpha), F.lit(0.0)) if alpha else g
    return math.copysign(max(abs(g) - alpha, 0.0), g)


def loss(a, b, rules: Rules):
    """What a leaf of sums (a, b) costs: weighted impurity of class weights, or the second-order loss of (gradient, hessian)."""
    column = isinstance(a, Column)
    if rules.criterion == "second_order":
        if column:
            return -(soft(a, rules.reg_alpha) ** 2) / F.nullif(b + F.lit(rules.reg_lambda), F.lit(0.0))
        return -(soft(a, rules.reg_alpha) ** 2) / (b + rules.reg_lambda) if b + rules.reg_lambda else 0.0
    if rules.criterion == "gini":
        return 2 * a * b / F.nullif(a + b, F.lit(0.0)) if column else (2 * a * b / (a + b) if a + b else 0.0)
    if column:
        return sum((F.when(x > 0, -x * F.log2(x / (a + b))).otherwise(0.0) for x in (a, b)), F.lit(0.0))
    return sum(-x * math.log2(x / (a + b)) for x in (a, b) if x > 0)


def leaf_value(a: float, b: float, rules: Rules) -> float:
    """Share of class 1, or the second-order step -G / (H + lambda)."""
    if rules.criterion == "second_order":
        return -soft(a, rules.reg_alpha) / (b + rules.reg_lambda) if b + rules.reg_lambda else 0.0
    return b / (a + b) if a + b else 0.0


@dataclass
class Tree:
    """Nodes in the order they were made; node 0 is the root, a leaf has feature -1. ``a`` and ``b`` are the sums of the node."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    n: list[int] = field(default_factory=list)
    a: list[float] = field(default_factory=list)
    b: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, depth: int, n: int = 0, a: float = 0.0, b: float = 0.0) -> int:
        for name, value in zip(("feature", "bin", "left", "right", "depth", "n", "a", "b", "gain"), (-1, 0, -1, -1, depth, n, a, b, 0.0), strict=True):
            getattr(self, name).append(value)
        return len(self.feature) - 1

    def split(self, node: int, best: dict) -> tuple[int, int]:
        """Give ``node`` its best split; its children know their sums without another pass."""
        d = self.depth[node] + 1
        left = self.add(d, best["nl"], best["al"], best["bl"])
        right = self.add(d, self.n[node] - best["nl"], self.a[node] - best["al"], self.b[node] - best["bl"])
        self.feature[node], self.bin[node], self.left[node], self.right[node], self.gain[node] = best["feature"], best["bin"], left, right, best["gain"]
        return left, right

    def leaves(self) -> list[int]:
        return [i for i in self.reachable() if self.feature[i] < 0]

    def reachable(self) -> list[int]:
        out, todo = [], [0] if self.feature else []
        while todo:
            i = todo.pop()
            out.append(i)
            if self.feature[i] >= 0:
                todo += [self.right[i], self.left[i]]
        return out

    def compact(self) -> "Tree":
        """Without the nodes that cannot be reached any more; parents before children."""
        keep = sorted(self.reachable())
        at = {old: new for new, old in enumerate(keep)} | {-1: -1}
        out = Tree()
        for name in ("feature", "bin", "depth", "n", "a", "b", "gain"):
            setattr(out, name, [getattr(self, name)[i] for i in keep])
        out.left = [at[self.left[i]] if self.feature[i] >= 0 else -1 for i in keep]
        out.right = [at[self.right[i]] if self.feature[i] >= 0 else -1 for i in keep]
        return out


def walk(tree: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """Node of every row of a matrix of bins."""
    # A leaf leads to itself, so all rows take the same steps; those that are there already stay.
    leaf = tree["feature"] < 0
    itself = np.arange(len(leaf))
    ways = np.where(leaf, itself, (tree["left"], tree["right"])).T.ravel()
    feature, limit = np.where(leaf, 0, tree["feature"]).astype(np.int64), tree["bin"]
    flat, start = np.ascontiguousarray(bins).ravel(), np.arange(len(bins)) * bins.shape[1]
    node = np.zeros(len(bins), np.int64)
    while not leaf.take(node).all():
        node = ways.take(2 * node + (flat.take(start + feature.take(node)) > limit.take(node)))
    return node


def _arrays(tree: Tree) -> dict[str, np.ndarray]:
    return {n: np.array(getattr(tree, n), np.int32) for n in ("feature", "bin", "left", "right")}


# ---- binned rows -----------------------------------------------------------------------------------


def bin_edges(df: DataFrame, width: int, bins: int = 32, features: str = "features") -> list[list[float]]:
    """Rising limits per feature: midpoints between its values if there are at most ``bins``, else exact quantiles.

    A value belongs to the first limit that is not below it; missing numbers come last.
    """
    if not 2 <= bins <= 256:
        raise ValueError("bins must be between 2 and 256")
    names = [f"f{j}" for j in range(width)]
    array = vector_to_array(features)
    cols = df.select(*[F.when(~F.isnan(array[j]), array[j]).alias(n) for j, n in enumerate(names)])
    rough = cols.agg(*[F.approx_count_distinct(n).alias(n) for n in names]).first()
    few = [n for n in names if rough[n] <= 2 * bins]
    held: dict[str, list[float]] = {}
    if few:
        pairs = cols.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in few])))
        values = pairs.where("value IS NOT NULL").distinct()
        # A feature of few values by a sketch's count has at most a few times ``bins`` of them.
        for r in values.groupBy("name").agg(F.array_sort(F.collect_set("value")).alias("values")).collect():
            held[r["name"]] = r["values"]
    many = [n for n in names if n not in few or len(held.get(n, [])) > bins]
    shares = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(cols, many, shares) if many else {}
    out = []
    for n in names:
        if n in many:
            out.append(sorted({cuts[(n, q)] for q in shares if cuts[(n, q)] is not None}))
        else:
            v = held.get(n, [])
            out.append([(x + y) / 2 for x, y in zip(v, v[1:])])
    return out


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, values[:, j])
    return out


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    """Rows of one width in an Arrow list column, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """Rows of one width in an Arrow binary column, as a matrix over the column's own memory."""
    _, offsets, data = column.buffers()
    first = int(np.frombuffer(offsets, np.int32, 1, 4 * column.offset)[0]) if len(column) else 0
    return np.frombuffer(data or b"", np.uint8, len(column) * width, first).reshape(len(column), width)


def _bin_batches(batches: Iterator[pa.RecordBatch], edges: list[list[float]]) -> Iterator[pa.RecordBatch]:
    limits = [np.array(e) for e in edges]
    for batch in batches:
        x = _binned(_matrix(batch.column("x"), len(limits), np.float64), limits)
        packed = pa.array([r.tobytes() for r in x], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("y"), batch.column("w"), packed, pa.array(np.zeros(len(x)))], ["uid", "y", "w", "bins", "margin"])


_ROWS = "uid long, y double, w double, bins binary, margin double"


def bin_rows(df: DataFrame, edges: list[list[float]], features: str = "features", label: str = "label") -> DataFrame:
    """Stored rows (uid, y, w, bins, margin) of a table with features, label and, if it is there, weight and key."""
    weight = F.col("weight").cast("double") if "weight" in df.columns else F.lit(1.0)
    array = vector_to_array(features)
    uid = F.xxhash64(F.col("key").cast("string")) if "key" in df.columns else F.xxhash64(array, F.col(label))
    rows = df.select(uid.alias("uid"), F.col(label).cast("double").alias("y"), weight.alias("w"), array.alias("x"))
    return materialize(rows.mapInArrow(partial(_bin_batches, edges=edges), _ROWS), "binned")


# ---- cells and splits ------------------------------------------------------------------------------


def uniform(uid: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A draw in [0, 1) per row and tree (the splitmix64 finaliser of the row's digest)."""
    with np.errstate(over="ignore"):
        z = uid.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed * 1_000_003 + tree + 1)) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * (1.0 / (1 << 53))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


@dataclass(frozen=True)
class Draw:
    """How rows enter a tree: all, a share of them, or a bootstrap (a Poisson count per row)."""

    share: float = 1.0
    bootstrap: bool = False
    seed: int = 1

    def counts(self, uid: np.ndarray, tree: int) -> np.ndarray | None:
        if self.bootstrap:
            return np.searchsorted(_POISSON, uniform(uid, self.seed, tree), side="right").astype(np.float64)
        return (uniform(uid, self.seed, tree) < self.share).astype(np.float64) if self.share < 1 else None


@dataclass
class _Pass:
    """What the tasks of one pass need: trees, the slot of each wanted node, the features of every slot (as many for each), trees whose margin is still to add."""

    trees: dict[int, dict[str, np.ndarray]]
    slots: dict[int, np.ndarray]
    many: int
    features: np.ndarray
    siblings: np.ndarray  # per slot the slot of a sibling that is not counted, or -1
    width: int
    bins: int
    draw: Draw
    second_order: bool
    pending: list[tuple[dict[str, np.ndarray], np.ndarray]]


def _margins(margin: np.ndarray, x: np.ndarray, pending) -> np.ndarray:
    for tree, values in pending:
        margin = margin + values[walk(tree, x)]
    return margin


def _count(batches: Iterator[pa.RecordBatch], job: _Pass) -> Iterator[pa.RecordBatch]:
    """The cells of this task: rows and both sums per (slot, feature, bin)."""
    chosen = job.features.shape[1]
    cells = np.zeros((chosen, 3, job.many * job.bins))
    columns_of = np.ascontiguousarray(job.features.T.astype(np.int64))
    alike = bool((job.features == job.features[:1]).all())
    # A tree's slots lie together, and a batch is counted over these alone.
    spans = {t: (int(s[s >= 0].min()), int(s.max()) + 1) for t, s in job.slots.items()}
    only = next(iter(job.trees)) if len(job.trees) == 1 else None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _bytes(batch.column("bins"), job.width)
        uid, y, w = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "y", "w")]
        margin = batch.column("margin").to_numpy(zero_copy_only=False) if job.second_order else y
        drawn = None if only is None else job.draw.counts(uid, only)
        if drawn is not None:
            # Rows that enter no tree of the pass are left out before their margins are summed.
            held = np.flatnonzero(drawn)
            x, uid, y, w, margin, drawn = (v[held] for v in (x, uid, y, w, margin, drawn))
        if job.second_order:
            p = 1 / (1 + np.exp(-_margins(margin, x, job.pending)))
            first, second = w * (p - y), w * p * (1 - p)
        else:
            first, second = w * (1 - y), w * y
        for t, tree in job.trees.items():
            if only is None:
                drawn = job.draw.counts(uid, t)
            rows = np.arange(len(x)) if drawn is None else np.flatnonzero(drawn)
            mine = x if len(rows) == len(x) else x[rows]
            slot = job.slots[t][walk(tree, mine)]
            wanted = np.flatnonzero(slot >= 0)
            if not len(wanted):
                continue
            rows, mine, slot = rows[wanted], mine[wanted], slot[wanted]
            times = 1.0 if drawn is None else drawn[rows]
            a, b = first[rows] * times, second[rows] * times
            low, high = spans[t]
            base, size = (slot - low).astype(np.int64) * job.bins, (high - low) * job.bins
            flat, start = mine.ravel(), np.arange(len(mine)) * job.width
            for c in range(chosen):
                at = base + flat.take(start + (columns_of[c, 0] if alike else columns_of[c].take(slot)))
                part = cells[c, :, low * job.bins : high * job.bins]
                part[0] += np.bincount(at, minlength=size)
                part[1] += np.bincount(at, a, size)
                part[2] += np.bincount(at, b, size)
    for c in range(chosen):
        flat = np.flatnonzero(cells[c, 0])
        slot, bin_ = flat // job.bins, flat % job.bins
        feature, other = job.features[slot, c], job.siblings[slot]
        n, a, b = cells[c][:, flat]
        # What a node holds is taken from its sibling, which starts as all of the parent.
        for to, sign, at in ((slot, 1, np.arange(len(flat))), (other, -1, np.flatnonzero(other >= 0))):
            columns = [to[at].astype(np.int32), feature[at].astype(np.int32), bin_[at].astype(np.int32)]
            columns += [(sign * n[at]).astype(np.int64), sign * a[at], sign * b[at]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["slot", "feature", "bin", "n", "a", "b"])


_CELLS = "slot int, feature int, bin int, n long, a double, b double"


def best_splits(cells: DataFrame, rules: Rules) -> DataFrame:
    """Per slot the best split of its cells: feature, bin (rows up to it go left), gain, sums of the node and of its left side.

    A slot without an allowed split has ``allowed`` false. Equal gains (per unit of weight, to ten digits) go to the smaller feature,
    then the smaller bin, so sums of doubles in another order choose the same split.
    """
    whole = Window.partitionBy("slot", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    for c in ("n", "a", "b"):
        cells = cells.withColumn(f"{c}l", F.sum(c).over(upto)).withColumn(f"{c}t", F.sum(c).over(whole))
    rest = {c: F.col(f"{c}t") - F.col(f"{c}l") for c in ("n", "a", "b")}
    gain = loss(F.col("at"), F.col("bt"), rules) - loss(F.col("al"), F.col("bl"), rules) - loss(rest["a"], rest["b"], rules)
    fair = (F.col("nl") >= rules.min_samples_leaf) & (rest["n"] >= rules.min_samples_leaf) & (rest["n"] > 0)
    if rules.criterion == "second_order":
        fair = fair & (F.col("bl") >= rules.min_child_weight) & (rest["b"] >= rules.min_child_weight)
        # Rounding must not pass for a gain.
        fair = fair & (gain > F.greatest(F.lit(rules.gamma), F.lit(1e-6)))
    else:
        fair = fair & (F.col("at") > 0) & (F.col("bt") > 0)
    found = cells.withColumn("gain", F.coalesce(gain, F.lit(0.0))).withColumn("allowed", F.coalesce(fair, F.lit(False)))
    size = F.col("bt") + (F.lit(rules.reg_lambda) if rules.criterion == "second_order" else F.col("at"))
    rank = F.struct("allowed", F.round(F.col("gain") / F.nullif(size, F.lit(0.0)), 10).alias("g"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("i"))
    kept = F.struct("allowed", "feature", "bin", "gain", F.col("nt").alias("n"), F.col("at").alias("a"), F.col("bt").alias("b"), "nl", "al", "bl")
    return found.groupBy("slot").agg(F.max(F.struct(rank.alias("rank"), kept.alias("kept"))).alias("best")).select("slot", "best.kept.*")


class Grower:
    """Grows trees over one table of binned rows."""

    def __init__(self, rows: DataFrame, width: int, bins: int, rules: Rules, draw: Draw = Draw(), cells: int = CELLS, max_nodes: int = MAX_NODES):
        self.rows, self.width, self.bins, self.rules, self.draw = rows, width, bins, rules, draw
        self.cells, self.max_nodes = cells, max_nodes
        self.kept: dict[tuple[int, int], tuple[DataFrame, int]] = {}  # counted cells of a node, for its children
        self.tables: list[DataFrame] = []
        self.passes = 0

    def splits(self, trees: dict[int, Tree], nodes: Sequence[tuple[int, int]], features: Sequence[int] | None = None, pending=()) -> dict[tuple[int, int], dict]:
        """Best split and sums of the given (tree, node) pairs; ``features`` limits all of them to some features."""
        if sum(len(t.feature) for t in trees.values()) > self.max_nodes:
            raise ValueError(f"the trees have more than {self.max_nodes} nodes; set max_depth, max_leaves or min_samples_leaf")
        chosen = self.rules.features_of(self.width)
        by_sibling = chosen is None and features is None and len(trees) == 1
        found: dict[tuple[int, int], dict] = {}
        counted = min(x for x in (chosen, None if features is None else len(features), self.width) if x is not None)
        group = max(2, self.cells // (counted * self.bins))
        for start in range(0, len(nodes), group):
            part = list(nodes[start : start + group])
            for r in self._best(trees, part, self._features(part, chosen, features), list(pending), by_sibling):
                found[part[r["slot"]]] = r
        return found

    def _best(self, trees, part, features, pending, by_sibling) -> list[dict]:
        return [r.asDict() for r in best_splits(self._cells(trees, part, features, pending, by_sibling), self.rules).collect()]

    def _features(self, part, chosen, features) -> np.ndarray:
        """The features that every node may be split by, rising, one row per node."""
        pool = np.arange(self.width) if features is None else np.array(sorted(features))
        if chosen is None:
            return np.tile(pool, (len(part), 1))
        return np.array([np.sort(np.random.default_rng([self.draw.seed, t, node]).permutation(pool)[: min(chosen, len(pool))]) for t, node in part])

    def _cells(self, trees, part, features, pending, by_sibling) -> DataFrame:
        """Cells of the wanted nodes. With ``by_sibling`` the larger of two siblings is the parent less the smaller."""
        slot_of = {node: s for s, node in enumerate(part)}
        derived: dict[int, tuple[DataFrame, int, int]] = {}  # slot -> (parent's cells, parent's slot, sibling's slot)
        if by_sibling:
            for (t, node), s in slot_of.items():
                tree = trees[t]
                # Children are made in pairs, the left one first.
                parent = next((p for p in ((t, q) for q in tree_parents(tree, node)) if p in self.kept), None)
                if parent is None:
                    continue
                other = tree.left[parent[1]] + tree.right[parent[1]] - node
                if (t, other) in slot_of and slot_of[(t, other)] not in derived and (tree.n[node], node) > (tree.n[other], other):
                    derived[s] = (*self.kept[parent], slot_of[(t, other)])
        slots = {t: np.full(len(tree.feature), -1, np.int32) for t, tree in trees.items()}
        for (t, node), s in slot_of.items():
            if s not in derived:
                slots[t][node] = s
        wanted = {t: v for t, v in slots.items() if (v >= 0).any()}
        siblings = np.full(len(part), -1, np.int64)
        for s, (_, _, counted) in derived.items():
            siblings[counted] = s
        job = _Pass({t: _arrays(trees[t]) for t in wanted}, wanted, len(part), features, siblings, self.width, self.bins, self.draw, self.rules.criterion == "second_order", pending)
        spark = self.rows.sparkSession
        shared = spark.sparkContext.broadcast(job)

        def count(batches):
            yield from _count(batches, shared.value)

        self.passes += 1
        cells = self.rows.mapInArrow(count, _CELLS)
        for table in {id(d[0]): d[0] for d in derived.values()}.values():
            moves = spark.createDataFrame([(p, s) for s, (d, p, _) in derived.items() if d is table], "slot int, to int")
            cells = cells.unionByName(table.join(F.broadcast(moves), "slot").select(F.col("to").alias("slot"), "feature", "bin", "n", "a", "b"))
        summed = cells.repartition(F.col("slot"), F.col("feature")).groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")]).where("n > 0")
        if by_sibling:
            summed = materialize(summed, "cells")
            for node, s in slot_of.items():
                self.kept[node] = (summed, s)
        return summed

    def may_split(self, tree: Tree, node: int) -> bool:
        """Before any pass: depth and size allow a split, and the node is not pure."""
        r = self.rules
        if r.max_depth is not None and tree.depth[node] >= r.max_depth:
            return False
        if tree.n[node] < max(r.min_samples_split, 2 * r.min_samples_leaf):
            return False
        if r.criterion == "second_order":
            return tree.b[node] >= 2 * r.min_child_weight
        return min(tree.a[node], tree.b[node]) > 1e-12 * (tree.a[node] + tree.b[node])

    def forest(self, many: int = 1, features: Sequence[int] | None = None, pending=(), first: int = 0) -> list[Tree]:
        """``many`` trees, numbered from ``first`` for their draws."""
        trees = {first + t: Tree() for t in range(many)}
        for tree in trees.values():
            tree.add(0)
        self.kept = {}
        roots = [(t, 0) for t in trees]
        found = self.splits(trees, roots, features, pending)
        for t, node in roots:
            if (t, node) in found:
                best = found[(t, node)]
                trees[t].n[0], trees[t].a[0], trees[t].b[0] = best["n"], best["a"], best["b"]
        if self.rules.max_leaves is None:
            self._by_level(trees, found, features, pending)
        else:
            for t, tree in trees.items():
                trees[t] = self._best_first(t, tree, found, features, pending)
        return list(trees.values())

    def _by_level(self, trees, found, features, pending) -> None:
        while found:
            following = []
            for (t, node), best in found.items():
                if best["allowed"] and self.may_split(trees[t], node):
                    following += [(t, c) for c in trees[t].split(node, best) if self.may_split(trees[t], c)]
            found = self.splits(trees, sorted(following), features, pending) if following else {}

    def _best_first(self, t: int, tree: Tree, found, features, pending) -> Tree:
        """Always the leaf of largest gain, until there are ``max_leaves``.

        The split of a leaf does not depend on the order, so a pass looks ahead: it also counts the children of the nodes of largest
        known gain, whether or not the order has come to them. The order is then replayed over what is known, so there are about as
        many passes as levels.
        """
        known = {node: b for (_, node), b in found.items()}
        while True:
            order, leaves, unknown = self._replay(tree, known)
            left = self.rules.max_leaves - len(leaves)
            if not unknown or left <= 0:
                break
            open_ = (n for n in known if tree.feature[n] < 0 and self._good(tree, n, known))
            for n in sorted(open_, key=lambda n: (-round(known[n]["gain"], 8), n))[:left]:
                unknown += [c for c in tree.split(n, known[n]) if self.may_split(tree, c)]
            for (_, node), b in self.splits({t: tree}, [(t, n) for n in sorted(set(unknown))], features, pending).items():
                known[node] = b
        done = set(order)
        for node in range(len(tree.feature)):
            if node not in done:
                tree.feature[node] = -1
        return tree.compact()

    def _good(self, tree: Tree, node: int, known) -> bool:
        return known[node]["allowed"] and self.may_split(tree, node)

    def _replay(self, tree: Tree, known) -> tuple[list[int], list[int], list[int]]:
        """(nodes split so far in order, leaves now, leaves whose split is not known yet)."""
        order, leaves = [], [0]
        queue = [(-round(known[0]["gain"], 8), 0)] if 0 in known and self._good(tree, 0, known) else []
        while queue and len(leaves) < self.rules.max_leaves:
            _, node = heapq.heappop(queue)
            if tree.feature[node] < 0:
                tree.split(node, known[node])
            order.append(node)
            leaves.remove(node)
            children = [tree.left[node], tree.right[node]]
            leaves += children
            unknown = [c for c in children if c not in known and self.may_split(tree, c)]
            if unknown and len(leaves) < self.rules.max_leaves:
                return order, leaves, [n for n in leaves if n not in known and self.may_split(tree, n)]
            for c in children:
                if c in known and self._good(tree, c, known):
                    heapq.heappush(queue, (-round(known[c]["gain"], 8), c))
        return order, leaves, []


@dataclass
class Patterns:
    """The different rows (bins, y, w) of a table of binned rows, and the table as (uid, pattern)."""

    rows: DataFrame
    x: np.ndarray
    y: np.ndarray
    w: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, width: int, most: int) -> "Patterns | None":
        """None if there are more than ``most``."""
        spark, what = rows.sparkSession, ["bins", "y", "w"]
        if rows.agg(F.approx_count_distinct(F.xxhash64(*what))).first()[0] > 2 * most:
            return None
        found = collect_bounded(rows.select(*what).distinct(), most)
        if found is None:
            return None
        # In an order of their own, so that sums do not depend on partitioning.
        found.sort(key=lambda r: (bytes(r["bins"]), str(r["y"]), str(r["w"])))
        table = spark.createDataFrame([(i, *r) for i, r in enumerate(found)], "pattern int, b binary, py double, pw double")
        same = F.col("bins").eqNullSafe(F.col("b")) & F.col("y").eqNullSafe(F.col("py")) & F.col("w").eqNullSafe(F.col("pw"))
        # A task gets few patterns and all of their rows, a pattern of many rows goes to several tasks.
        dealt = rows.join(F.broadcast(table), same).select("uid", "pattern").repartitionByRange(2 * spark.sparkContext.defaultParallelism, "pattern", "uid")
        x = np.frombuffer(b"".join(bytes(r["bins"]) for r in found), np.uint8).reshape(len(found), width)
        y, w = (np.array([r[c] for r in found], np.float64) for c in ("y", "w"))
        return cls(materialize(dealt, "patterns"), x, y, w)

    def tallies(self, draw: Draw, trees: Sequence[int]) -> Iterator[np.ndarray]:
        """Per tree the number of drawn rows of every pattern; as many trees share a pass as ``TALLIES`` allows."""
        many = len(self.y)
        group = max(1, TALLIES // max(1, many)) if draw.share < 1 else len(trees)
        for start in range(0, len(trees), group):
            part = list(trees[start : start + group])
            asked = part if draw.share < 1 else part[:1]  # without a draw all trees count the same
            out = np.zeros((len(asked), many), np.int64)
            for r in self.rows.mapInArrow(partial(_tally, draw=draw, trees=asked), "at int, low int, counts binary").toLocalIterator():
                counts = np.frombuffer(r["counts"], np.int64)
                out[r["at"], r["low"] : r["low"] + len(counts)] += counts
            for i in range(len(part)):
                yield out[i if draw.share < 1 else 0]


def _tally(batches: Iterator[pa.RecordBatch], draw: Draw, trees: list[int]) -> Iterator[pa.RecordBatch]:
    """Drawn rows per tree (``at`` in ``trees``) and pattern, from the pattern ``low`` on, of this task."""
    low, counts, held, rows = 0, np.zeros((len(trees), 0), np.int64), [], 0

    def count(low, counts):
        uid, pattern = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        first, last = int(pattern.min()), int(pattern.max()) + 1
        if counts.shape[1]:
            first, last = min(first, low), max(last, low + counts.shape[1])
        wider = np.zeros((len(trees), last - first), np.int64)
        wider[:, low - first : low - first + counts.shape[1]] = counts
        for i, t in enumerate(trees):
            drawn = draw.counts(uid, t)
            wider[i] += np.bincount((pattern if drawn is None else pattern[drawn > 0]) - first, minlength=last - first)
        return first, wider

    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "pattern")])
            rows += batch.num_rows
        if rows >= TALLY_ROWS:
            low, counts = count(low, counts)
            held, rows = [], 0
    if held:
        low, counts = count(low, counts)
    for i in range(len(trees) if counts.shape[1] else 0):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([low], pa.int32()), pa.array([counts[i].tobytes()], pa.binary())], ["at", "low", "counts"])


class PatternGrower(Grower):
    """Grows one tree over patterns: ``n`` rows each, with sums ``first`` and ``second``."""

    def __init__(self, x: np.ndarray, n: np.ndarray, first: np.ndarray, second: np.ndarray, bins: int, rules: Rules, draw: Draw, cells: int = CELLS, max_nodes: int = MAX_NODES):
        super().__init__(None, x.shape[1], bins, rules, draw, cells, max_nodes)
        held = np.flatnonzero(n)
        self.x, self.n, self.sums = np.ascontiguousarray(x[held]), n[held], (first[held], second[held])

    def _best(self, trees, part, features, pending, by_sibling) -> list[dict]:
        ((t, tree),) = trees.items()
        slots = np.full(len(tree.feature), -1, np.int64)
        for s, (_, node) in enumerate(part):
            slots[node] = s
        slot = slots[walk(_arrays(tree), self.x)]
        rows = np.flatnonzero(slot >= 0)
        slot, shape = slot[rows], (len(part), features.shape[1], self.bins)
        cells = np.zeros((3, *shape))
        for c in range(shape[1]):
            at = slot * self.bins + self.x[rows, features[slot, c]]
            for out, values in zip(cells, (self.n, *self.sums), strict=True):
                out[:, c] = np.bincount(at, values[rows], len(part) * self.bins).reshape(len(part), self.bins)
        self.passes += 1
        return [r for s in range(len(part)) if (r := best_split(cells[:, s], features[s], self.rules)) is not None and not r.update(slot=s)]


def best_split(cells: np.ndarray, features: np.ndarray, rules: Rules) -> dict | None:
    """What ``best_splits`` finds for one slot, from its cells (n, a, b by feature and bin); None if it has no rows."""
    at, bin_ = np.nonzero(cells[0] > 0)
    if not len(at):
        return None
    n, a, b = ({"l": np.cumsum(c, 1)[at, bin_], "t": c.sum(1)[at]} for c in cells)
    rest = {k: s["t"] - s["l"] for k, s in (("n", n), ("a", a), ("b", b))}
    gain = _losses(a["t"], b["t"], rules) - _losses(a["l"], b["l"], rules) - _losses(rest["a"], rest["b"], rules)
    fair = (n["l"] >= rules.min_samples_leaf) & (rest["n"] >= rules.min_samples_leaf) & (rest["n"] > 0)
    if rules.criterion == "second_order":
        fair &= (b["l"] >= rules.min_child_weight) & (rest["b"] >= rules.min_child_weight) & (gain > max(rules.gamma, 1e-6))
        size = b["t"] + rules.reg_lambda
    else:
        fair &= (a["t"] > 0) & (b["t"] > 0)
        size = a["t"] + b["t"]
    fair &= ~np.isnan(gain)
    gain = np.where(np.isnan(gain), 0.0, gain)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(size == 0, -np.inf, np.round(gain / size, 10))
    best = np.lexsort((-bin_, -features[at], share, fair))[-1]
    out = {"allowed": bool(fair[best]), "feature": int(features[at[best]]), "bin": int(bin_[best]), "gain": float(gain[best])}
    out |= {k: float(s["t"][best]) for k, s in (("a", a), ("b", b))} | {f"{k}l": float(s["l"][best]) for k, s in (("a", a), ("b", b))}
    return out | {"n": int(n["t"][best]), "nl": int(n["l"][best])}


def _losses(a: np.ndarray, b: np.ndarray, rules: Rules) -> np.ndarray:
    """``loss`` of many leaves; NaN where it is not defined."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if rules.criterion == "second_order":
            shrunk = np.sign(a) * np.maximum(np.abs(a) - rules.reg_alpha, 0.0) if rules.reg_alpha else a
            return np.where(b + rules.reg_lambda == 0, np.nan, -(shrunk**2) / (b + rules.reg_lambda))
        if rules.criterion == "gini":
            return np.where(a + b == 0, np.nan, 2 * a * b / (a + b))
        return sum(np.where(x > 0, -x * np.log2(x / (a + b)), 0.0) for x in (a, b))


def tree_parents(tree: Tree, node: int) -> list[int]:
    """The parent of ``node`` in a list, empty for the root."""
    if not hasattr(tree, "_parents"):
        tree._parents = {}
    known = tree._parents
    if node not in known:
        for p, f in enumerate(tree.feature):
            if f >= 0:
                known[tree.left[p]] = known[tree.right[p]] = p
    return [known[node]] if node in known else []


# ---- pruning ---------------------------------------------------------------------------------------


def pruning_path(tree: Tree, rules: Rules) -> list[tuple[float, int, float]]:
    """(alpha, leaves, impurity) of every tree of the weakest-link sequence (Breiman et al., 1984), from the whole tree to its root.

    Impurity is the weighted impurity of all leaves over the weight of the root.
    """
    return [(a, n, i) for a, n, i, _ in _prune(tree, rules, math.inf)]


def pruned(tree: Tree, rules: Rules, alpha: float) -> Tree:
    """The smallest tree of the weakest-link sequence whose cost per leaf does not exceed ``alpha``; 0 takes only splits that gain nothing."""
    if alpha < 0:
        raise ValueError("alpha must not be negative")
    if not alpha:
        return tree
    out = tree.compact()
    for _, _, _, node in _prune(tree.compact(), rules, alpha)[1:]:
        out.feature[node] = -1
    return out.compact()


def _prune(tree: Tree, rules: Rules, upto: float) -> list[tuple[float, int, float, int]]:
    total = tree.a[0] + tree.b[0] or 1.0
    cost = [loss(a, b, rules) / total for a, b in zip(tree.a, tree.b)]
    parent = {c: p for p in range(len(cost)) if tree.feature[p] >= 0 for c in (tree.left[p], tree.right[p])}
    many, below = [1] * len(cost), list(cost)
    for p in reversed(range(len(cost))):
        if tree.feature[p] >= 0:
            many[p] = many[tree.left[p]] + many[tree.right[p]]
            below[p] = below[tree.left[p]] + below[tree.right[p]]
    gone: set[int] = set()

    def weak(p: int) -> float:
        return (cost[p] - below[p]) / (many[p] - 1)

    version = [0] * len(cost)
    queue = [(weak(p), p, 0) for p in range(len(cost)) if many[p] > 1]
    heapq.heapify(queue)
    path, last = [(0.0, many[0], below[0], -1)], 0.0
    while queue and many[0] > 1:
        alpha, node, seen = heapq.heappop(queue)
        if node in gone or seen != version[node] or many[node] == 1:
            continue
        if alpha > upto:
            break
        todo = [node]
        while todo:
            i = todo.pop()
            if many[i] > 1:
                todo += [tree.left[i], tree.right[i]]
            if i != node:
                gone.add(i)
        fewer, more = many[node] - 1, cost[node] - below[node]
        many[node], below[node] = 1, cost[node]
        up = node
        while up in parent:
            up = parent[up]
            many[up] -= fewer
            below[up] += more
            version[up] += 1
            heapq.heappush(queue, (weak(up), up, version[up]))
        last = max(last, alpha)
        path.append((last, many[0], below[0], node))
    return path


# ---- models ----------------------------------------------------------------------------------------


class GrownTrees(_Columns, Model):
    """Grown trees as a stage: probability and prediction from ``features``. The fitted state is JSON text, so it saves like any stage."""

    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in self.fitted()["trees"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted()
        score = _scorer(s)
        p = score(vector_to_array(self.getInputCols()[0]))
        out = df.withColumn("_p1", F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
        out = out.withColumn("prediction", (F.col("_p1") > 0.5).cast("double"))
        return out.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p1"), F.col("_p1")))).drop("_p1")

    def node_table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, path, feature, threshold, left, right, depth, n, a, b, gain, value) of all nodes; a path spells the way from the root."""
        s = self.fitted()
        rows = []
        for t, tree in enumerate(self.trees()):
            path = {0: ""}
            for i in range(len(tree.feature)):
                f = tree.feature[i]
                if f >= 0:
                    path |= {tree.left[i]: path[i] + "l", tree.right[i]: path[i] + "r"}
                limit = float(s["edges"][f][tree.bin[i]]) if f >= 0 else None
                sums = [float(v) for v in (tree.a[i], tree.b[i], tree.gain[i], s["values"][t][i])]
                rows.append((t, i, path[i], f, limit, tree.left[i], tree.right[i], tree.depth[i], int(tree.n[i]), *sums))
        return spark.createDataFrame(rows, _NODES)


_NODES = (
    "tree int, node int, path string, feature int, threshold double, left int, right int, depth int, n long, a double, b double, gain double, value double"
)


def _scorer(state: dict):
    """A vectorised function: rows are binned, walk all trees, and the values of their leaves are averaged or summed."""
    trees = [(_arrays(Tree(**t)), np.array(v, np.float64)) for t, v in zip(state["trees"], state["values"])]
    edges = [np.array(e) for e in state["edges"]]
    boosted, rate = state["boosted"], state["rate"]
    sizes = [len(e) + 1 for e in edges]
    combinations = math.prod(sizes)
    few = combinations <= SCORES
    step = np.array([math.prod(sizes[:j]) for j in range(len(sizes))], np.int64) if few else None
    kept: dict[str, np.ndarray] = {}

    def summed(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree, values in trees:
            total += values[walk(tree, x)]
        return total

    def looked_up(x: np.ndarray) -> np.ndarray:
        """The same sums; a combination of bins is summed when it is first met."""
        if not kept:
            kept["total"], kept["known"] = np.zeros(combinations), np.zeros(combinations, bool)
        at = x @ step
        new, first = np.unique(np.where(kept["known"][at], -1, at), return_index=True)
        new, first = new[new >= 0], first[new >= 0]
        if len(new):
            kept["total"][new], kept["known"][new] = summed(x[first]), True
        return kept["total"][at]

    @F.pandas_udf("double")
    def score(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype="float64")
        x = _binned(np.stack(v.to_numpy()), edges)
        total = looked_up(x) if few else summed(x)
        return pd.Series(1 / (1 + np.exp(-rate * total)) if boosted else total / max(1, len(trees)))

    return score


def as_stage(made: Sequence[Tree], edges: list[list[float]], rules: Rules, boosted: bool = False, rate: float = 1.0) -> GrownTrees:
    """Trees as a stage: shares of class 1 are averaged, second-order steps are added up."""
    names = ("feature", "bin", "left", "right", "depth", "n", "a", "b", "gain")
    state = {
        "trees": [{n: [x if isinstance(x, float) else int(x) for x in getattr(t, n)] for n in names} for t in made],
        "values": [[leaf_value(a, b, rules) for a, b in zip(t.a, t.b)] for t in made],
        "edges": edges, "boosted": boosted, "rate": rate,
    }
    return GrownTrees(inputCols=["features"], outputCols=["probability"], state=json.dumps(state))


class TreeLearner(Estimator):
    """Grows one tree, a forest or a boosted sequence on (features, label[, weight][, key])."""

    def __init__(
        self, rules: Rules, trees: int = 1, bins: int = 32, draw: Draw = Draw(), boosted: bool = False, rate: float = 0.1,
        columns: float = 1.0, ccp_alpha: float = 0.0,
    ):
        super().__init__()
        self.rules, self.trees, self.bins, self.draw = rules, trees, bins, draw
        self.boosted, self.rate, self.columns, self.ccp_alpha = boosted, rate, columns, ccp_alpha

    def _fit(self, df: DataFrame) -> PipelineModel:
        first = df.select(F.size(vector_to_array("features"))).first()
        if first is None:
            raise ValueError("no rows to fit on")
        width = first[0]
        edges = bin_edges(df, width, self.bins)
        rows = bin_rows(df, edges)
        made = self._boost(rows, width) if self.boosted else Grower(rows, width, self.bins, self.rules, self.draw).forest(self.trees)
        if self.ccp_alpha:
            made = [pruned(t, self.rules, self.ccp_alpha) for t in made]
        return PipelineModel(stages=[as_stage(made, edges, self.rules, self.boosted, self.rate)])

    def _boost(self, rows: DataFrame, width: int) -> list[Tree]:
        """Trees on the gradients of the log loss; margins are stored every few trees and added up in the tasks between."""
        # A bootstrap counts rows and how often they were drawn, which patterns do not tell apart.
        patterns = Patterns.of(rows, width, PATTERNS) if self.trees > 1 and not self.draw.bootstrap else None
        if patterns is not None:
            return self._boost_patterns(patterns, width)
        made: list[Tree] = []
        pending: list = []
        for t in range(self.trees):
            grower = Grower(rows, width, self.bins, self.rules, self.draw)
            tree = grower.forest(1, self._columns_of(t, width), pending, first=t)[0]
            made.append(tree)
            pending.append((_arrays(tree), self._steps(tree)))
            if len(pending) == STORE_EVERY and t + 1 < self.trees:
                rows, pending = _with_margins(rows, pending, width), []
        return made

    def _boost_patterns(self, patterns: Patterns, width: int) -> list[Tree]:
        made: list[Tree] = []
        margin = np.zeros(len(patterns.y))
        for t, n in enumerate(patterns.tallies(self.draw, range(self.trees))):
            p = 1 / (1 + np.exp(-margin))
            first, second = n * (patterns.w * (p - patterns.y)), n * (patterns.w * p * (1 - p))
            tree = PatternGrower(patterns.x, n, first, second, self.bins, self.rules, self.draw).forest(1, self._columns_of(t, width), first=t)[0]
            made.append(tree)
            margin = margin + self._steps(tree)[walk(_arrays(tree), patterns.x)]
        return made

    def _columns_of(self, t: int, width: int) -> list[int] | None:
        """The columns drawn for tree ``t``."""
        if self.columns >= 1:
            return None
        many = max(1, int(self.columns * width))
        return np.random.default_rng([self.draw.seed, t]).permutation(width)[:many].tolist()

    def _steps(self, tree: Tree) -> np.ndarray:
        """What a row's margin gains at every node."""
        return np.array([self.rate * leaf_value(a, b, self.rules) for a, b in zip(tree.a, tree.b)])


def _with_margins(rows: DataFrame, pending, width: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pending)

    def add(batches):
        for batch in batches:
            if batch.num_rows:
                margin = _margins(batch.column("margin").to_numpy(zero_copy_only=False), _bytes(batch.column("bins"), width), shared.value)
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margin))

    return materialize(rows.mapInArrow(add, _ROWS), "margins")
