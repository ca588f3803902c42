"""The tree of cells and the search inside a cell against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import neighbor_tree, neighbors
from riskloom.operators.neighbor_index import NeighborIndex
from riskloom.runtime import scratch_path


def distances(a, b, metric):
    gap = np.asarray(a)[:, None] - np.asarray(b)[None]
    return np.abs(gap).sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))


@pytest.mark.parametrize("metric", ["l2", "l1"])
@pytest.mark.parametrize("rows", [60, 1700, 5000])
def test_groups_find_what_a_whole_block_finds(metric, rows):
    """Copies, ties, an outlier, a dimension of one value and bounds change nothing."""
    rng = np.random.default_rng(rows)
    b = np.round(rng.normal(size=(rows, 4)), 1) * [1, 1, 1, 0]
    a = np.round(rng.normal(size=(400, 4)), 1) * [1, 1, 1, 0]
    a[:50], b[10:40], a[60], b[7] = b[:50], b[3], 1e4, -1e5
    for bound in (np.full(400, np.inf), rng.random(400), np.where(np.arange(400) % 3, np.inf, 0.0)):
        want, got = neighbors.block_top(a, b, 7, metric, bound=bound), neighbor_tree.cell_top(a, b, 7, metric, bound)
        assert all(np.array_equal(w, g) for w, g in zip(want, got, strict=True))


def test_few_pairs_are_compared(monkeypatch):
    """A cell's queries and rows used to be compared in full; copies are compared once."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=(9000, 2)), rng.integers(0, 3, (9000, 3))])
    x[:2000] = x[0]
    pairs, whole = [], neighbors.block_top
    monkeypatch.setattr(neighbor_tree, "block_top", lambda a, b, *r, **k: pairs.append(len(a) * len(b)) or whole(a, b, *r, **k))
    row, _, _ = neighbor_tree.cell_top(x, x, 11, "l2", np.full(9000, np.inf))
    assert np.bincount(row).tolist() == [11] * 9000 and sum(pairs) < 9000 * 9000 / 3


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_a_tree_deals_out_rows_and_finds_cells(metric):
    rng = np.random.default_rng(5)
    x = np.column_stack([np.exp(3 * rng.normal(size=3000)), rng.integers(0, 2, 3000), rng.normal(size=3000)])
    tree, pivots = neighbor_tree.CellTree.grow(x[:800], 25)
    again = neighbor_tree.CellTree.from_ways(tree.ways())
    cell = tree.home(x)
    assert len(pivots) == 25 and (again.home(x) == cell).all() and (tree.home(pivots) == np.arange(25)).all()
    low, high = (np.array([f(x[cell == c], axis=0) for c in range(25)]) for f in (np.min, np.max))
    bound = rng.random(3000)
    bound[5] = np.inf
    row, got = again.with_boxes(low, high, np.bincount(cell, minlength=25)).within(x, bound, metric)
    gap = np.maximum(np.maximum(low[None] - x[:, None], x[:, None] - high[None]), 0)
    near = (gap.sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))) <= bound[:, None]
    assert list(zip(row.tolist(), got.tolist())) == [(int(i), int(c)) for i, c in zip(*np.nonzero(near))]


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_keys_may_repeat_and_a_heap_may_be_larger_than_a_block(spark, monkeypatch, weights):
    """Ids that come twice share an answer from all their rows; of a heap of copies only the smallest ids are handed to tasks."""
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=(500, 2)).round(2), rng.integers(0, 2, 500)])
    x[100:300] = x[100]
    # Ids r100 to r119 have two rows each.
    names = [f"r{100 + i // 2 if i < 40 else 100 + i}" for i in range(500)]
    y = [int(v) for v in rng.integers(0, 2, 500)]
    rows = [(n, [float(v) for v in vec], c) for n, vec, c in zip(names, x, y)]
    df = spark.createDataFrame(rows, "id string, vec array<double>, y int")
    index = NeighborIndex.build(df, 2, 40)
    assert index.tree is not None and index.size.max() >= 200
    parts = index._parts(5)
    assert parts.heaps.count() < index.size.max() and parts.many.max() == 2

    dist, want = distances(x, x, "l2"), {}
    for name in sorted(set(names)):
        mine = [i for i, n in enumerate(names) if n == name]
        want[name] = sorted((dist[i, j], names[j], y[j]) for i in mine for j in range(500))[:5]
    got = {}
    for r in sorted(index.search(df, 5).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["distance"], r["neighbor_id"]))
    assert got.keys() == want.keys()
    for name, found in got.items():
        assert [d for d, _ in found] == pytest.approx([w[0] for w in want[name]], abs=1e-12)
        assert [n for _, n in found] == [w[1] for w in want[name]]

    def share(votes):
        exact = [v for d, _, v in votes if d == 0]
        if weights == "uniform":
            return sum(v for _, _, v in votes) / len(votes)
        return sum(exact) / len(exact) if exact else sum(v / d for d, _, v in votes) / sum(1 / d for d, _, _ in votes)

    far = df.withColumn("vec", F.transform("vec", lambda v: v + 0.001)).withColumn("id", F.concat(F.lit("q"), "id"))
    asked = df.unionByName(far.where("id >= 'qr200'"))
    votes = {r["id"]: (r["y_prob"], r["y_pred"]) for r in index.vote(asked, 5, weights).collect()}
    for i in range(500):
        if names[i] >= "r200":
            moved = distances([[v + 0.001 for v in x[i]]], x, "l2")[0]
            want["q" + names[i]] = sorted((moved[j], names[j], y[j]) for j in range(500))[:5]
    assert votes.keys() == want.keys()
    for name, (prob, pred) in votes.items():
        if name in got:
            assert prob == pytest.approx(share([(0.0 if d < 1e-12 else d, n, v) for d, n, v in want[name]])) and pred == int(prob > 0.5)
    near = [n for n in votes if n.startswith("q") and len({round(d, 9) for d, _, _ in want[n]}) == 5]
    assert near and all(votes[n][0] == pytest.approx(share(want[n]), abs=1e-6) for n in near)


def test_an_index_without_ways_still_answers(spark):
    """One that was saved before trees were kept."""
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(f"r{i:03d}", rng.normal(size=2).tolist(), i % 2) for i in range(300)], "id string, vec array<double>, y int")
    index = NeighborIndex.build(df, 2, 50)
    path = scratch_path(spark, "oldindex")
    index.save(path)
    spark.read.parquet(f"{index.path}/cells").drop("way").write.mode("overwrite").parquet(f"{path}/cells")
    old = NeighborIndex(spark, path)
    assert index.tree is not None and old.tree is None
    key = ["query_id", "rank", "neighbor_id", "y"]
    assert sorted(index.search(df, 4).select(*key).collect()) == sorted(old.search(df, 4).select(*key).collect())
    asked = spark.createDataFrame([(None, [0.0, 0.0]), (None, [0.1, 0.1]), ("a", [0.0, 0.0])], "id string, vec array<double>")
    assert [sorted(r["rank"] for r in index.search(asked, 3).where(F.col("query_id").eqNullSafe(F.lit(i))).collect()) for i in (None, "a")] == [[1, 2, 3]] * 2
