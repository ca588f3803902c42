import random

import numpy as np
import pytest

from riskloom.operators.neighbor_index import NeighborIndex
from riskloom.operators.neighbors import block_top, knn_vote, nearest_neighbors
from riskloom.runtime import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    """Ten far apart heaps, one of copies."""
    rnd = random.Random(4)
    out = []
    for i in range(600):
        heap = i % 10
        vec = [heap * 100.0 + rnd.random() * 3, (heap % 3) * 50.0 + rnd.random() * 3] if heap else [0.0, 0.0]
        out.append((f"r{i:03d}", vec, i % 3 == 0))
    return spark.createDataFrame([(i, v, int(y)) for i, v, y in out], "id string, vec array<double>, y int")


def plain(df):
    return sorted((r["query_id"], r["rank"], r["neighbor_id"], round(r["distance"], 9)) for r in df.collect())


@pytest.mark.parametrize("p,cell_rows,block_rows", [(2, 50, 7), (1, 50, 2048), (2, 10_000, 100), (2, 1, 2048)])
def test_answers_equal_the_exact_search(rows, p, cell_rows, block_rows):
    asked = rows.where("id < 'r120'")
    index = NeighborIndex.build(rows, p, cell_rows, block_rows)
    want = nearest_neighbors(asked, rows, 5, metric="l1" if p == 1 else "l2")
    assert plain(index.search(asked, 5)) == plain(want)


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_votes_equal_the_exact_votes(rows, weights):
    asked = rows.where("id >= 'r500'")
    got = {r["id"]: (round(r["y_prob"], 9), r["y_pred"]) for r in NeighborIndex.build(rows, 2, 40).vote(asked, 7, weights).collect()}
    want = {r["id"]: (round(r["y_prob"], 9), r["y_pred"]) for r in knn_vote(rows, asked, "y", 7, weights).collect()}
    assert got == want and len(got) == 100


def test_cells_that_cannot_matter_are_not_read(spark, rows):
    index = NeighborIndex.build(rows, 2, 40)
    asked = rows.where("vec[0] < 50 AND id < 'r200'")
    want = plain(index.search(asked, 3))
    near = index.pivots[:, 0] < 50
    assert near.any() and not near.all()
    # An index without the rows of the far cells gives the same answers.
    path = scratch_path(spark, "halfindex")
    index.rows_of(np.flatnonzero(near).tolist()).write.partitionBy("cell").parquet(f"{path}/rows")
    spark.read.parquet(f"{index.path}/cells").write.parquet(f"{path}/cells")
    assert plain(NeighborIndex(spark, path).search(asked, 3)) == want
    plan = index.rows_of([0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_few_rows_nulls_and_saving(spark, rows, tmp_path):
    few = rows.limit(3)
    index = NeighborIndex.build(few)
    index.save(f"{tmp_path}/i")
    asked = spark.createDataFrame([("q", [1.0, 2.0]), ("n", None)], "id string, vec array<double>")
    got = plain(NeighborIndex(spark, f"{tmp_path}/i").search(asked, 5))
    assert got == plain(index.search(asked, 5)) and [g[1] for g in got] == [1, 2, 3]
    assert index.search(asked.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        NeighborIndex.build(rows.limit(0))


@pytest.mark.parametrize("metric,farthest", [("l2", False), ("l2", True), ("l1", False), ("l1", True)])
@pytest.mark.parametrize("width,stretch", [(3, 1.0), (40, 1.0), (5, 1e6)])
def test_a_block_pair_gives_what_brute_force_gives(metric, farthest, width, stretch):
    """Cheap sums only choose whom to compare: copies, ties and far outliers change nothing."""
    rng = np.random.RandomState(width)
    a, b = np.round(rng.normal(size=(70, width)), 1), np.round(rng.normal(size=(1501, width)), 1)
    b[200:260] = b[3]
    a[5] = b[3]
    b[9] *= stretch
    gap = a[:, None] - b[None]
    d = np.abs(gap).sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))
    order = np.argsort(-d if farthest else d, axis=1, kind="stable")[:, :6]
    row, col, dist = block_top(a, b, 6, metric, farthest)
    assert (row == np.repeat(np.arange(70), 6)).all() and (col.reshape(70, 6) == order).all()
    assert np.allclose(dist.reshape(70, 6), np.take_along_axis(d, order, 1))
    # With the fourth distance as bound only rows as good as it come back.
    bound = np.take_along_axis(-d if farthest else d, order, 1)[:, 3]
    bound = np.where(np.arange(70) % 2, bound, np.inf)
    row, col, dist = block_top(a, b, 6, metric, farthest, bound)
    want = [(i, j) for i in range(70) for j in order[i] if (-d if farthest else d)[i, j] <= bound[i]]
    assert list(zip(row.tolist(), col.tolist())) == [(i, int(j)) for i, j in want]


def test_small_cells_are_visited_together(spark):
    """In many dimensions no cell can be left out: a query must not be handed to every one of many small cells."""
    rng = np.random.RandomState(2)
    table = spark.createDataFrame([(f"r{i:04d}", rng.normal(size=30).tolist(), 0) for i in range(900)], "id string, vec array<double>, y int")
    index = NeighborIndex.build(table, cell_rows=10)
    assert len(index.pivots) == 90
    assert len(set(index.cells().group.tolist())) == 1
    asked = table.where("id < 'r0020'")
    assert plain(index.search(asked, 4)) == plain(nearest_neighbors(asked, table, 4))
