"""Grown trees against a plain builder that tries every split of every node."""

import heapq
import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskloom.operators import trees as tr


def plain_tree(x, first, second, rules):
    """Nodes as (depth, n, feature, bin, a, b) by following the definition; best leaf first if ``max_leaves`` is set."""

    def cost(a, b):
        if rules.criterion == "second_order":
            a = math.copysign(max(abs(a) - rules.reg_alpha, 0), a)
            return -a * a / (b + rules.reg_lambda)
        if rules.criterion == "gini":
            return 2 * a * b / (a + b)
        return sum(-v * math.log2(v / (a + b)) for v in (a, b) if v > 0)

    def best(rows):
        a, b = first[rows].sum(), second[rows].sum()
        found = None
        for j in range(x.shape[1]):
            for cut in sorted(set(x[rows, j]))[:-1]:
                left, right = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                if min(len(left), len(right)) < rules.min_samples_leaf:
                    continue
                sums = [(first[r].sum(), second[r].sum()) for r in (left, right)]
                gain = cost(a, b) - cost(*sums[0]) - cost(*sums[1])
                if rules.criterion == "second_order" and (min(s[1] for s in sums) < rules.min_child_weight or gain <= max(rules.gamma, 1e-6)):
                    continue
                size = b + (rules.reg_lambda if rules.criterion == "second_order" else a)
                rank = (round(gain / size, 10), -j, -cut)
                if found is None or rank > found[0]:
                    found = (rank, j, int(cut), gain, left, right)
        return found

    def splittable(rows, depth):
        if rules.max_depth is not None and depth >= rules.max_depth or len(rows) < max(rules.min_samples_split, 2 * rules.min_samples_leaf):
            return None
        if rules.criterion != "second_order" and min(first[rows].sum(), second[rows].sum()) <= 0:
            return None
        return best(rows)

    out, leaves, count = [], 1, 0
    queue = [(0.0, 0, np.arange(len(x)), 0, splittable(np.arange(len(x)), 0))]
    while queue:
        _, _, rows, depth, split = heapq.heappop(queue)
        sums = (round(float(first[rows].sum()), 6), round(float(second[rows].sum()), 6))
        if split is None or (rules.max_leaves and leaves >= rules.max_leaves):
            out.append((depth, len(rows), -1, 0, *sums))
            continue
        leaves += 1
        out.append((depth, len(rows), split[1], split[2], *sums))
        for part in (split[4], split[5]):
            count += 1
            below = splittable(part, depth + 1)
            heapq.heappush(queue, (-round(below[3], 8) if below else 1.0, count, part, depth + 1, below))
    return sorted(out)


def nodes_of(tree):
    return sorted((tree.depth[i], int(tree.n[i]), tree.feature[i], tree.bin[i] if tree.feature[i] >= 0 else 0, round(tree.a[i], 6), round(tree.b[i], 6)) for i in tree.reachable())


def made_up(n=160, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [float(rnd.randint(0, 9)), rnd.choice([0.0, 1.0, 5.0]), round(rnd.random(), 2)]
        y = int((x[0] > 4) != (x[1] == 1.0)) if rnd.random() > 0.1 else rnd.randint(0, 1)
        rows.append((f"k{i}", x, y))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = made_up()
    df = spark.createDataFrame([(k, Vectors.dense(x), y) for k, x, y in rows], ["key", "features", "label"])
    edges = tr.bin_edges(df, 3, 12)
    binned = tr.bin_rows(df, edges)
    x = np.array([[np.searchsorted(edges[j], r[1][j]) for j in range(3)] for r in rows])
    y = np.array([r[2] for r in rows], float)
    return df, edges, binned, x, y


LEVEL = [
    tr.Rules(), tr.Rules("entropy", 4, 10, 3), tr.Rules(min_samples_split=30), tr.Rules(max_depth=1), tr.Rules("second_order", 3, reg_lambda=1.0, min_child_weight=1.0),
    tr.Rules("second_order", 4, reg_lambda=5.0, reg_alpha=1.5, gamma=0.2), tr.Rules(max_leaves=7), tr.Rules("second_order", max_leaves=9, reg_lambda=1.0, min_samples_leaf=4), tr.Rules("entropy", max_leaves=500),
]


@pytest.mark.parametrize("rules", LEVEL)
def test_same_nodes_as_the_plain_builder(table, rules):
    _, edges, binned, x, y = table
    grower = tr.Grower(binned, 3, 12, rules)
    tree = grower.forest()[0]
    first, second = (0.5 - y, np.full(len(y), 0.25)) if rules.criterion == "second_order" else (1 - y, y)
    assert nodes_of(tree) == plain_tree(x, first, second, rules)
    assert all(tree.n[i] >= max(rules.min_samples_split, 2 * rules.min_samples_leaf) for i in tree.reachable() if tree.feature[i] >= 0)
    assert grower.passes <= 2 + max(tree.depth) if rules.max_leaves is None else grower.passes <= 4 + 2 * max(tree.depth)


def test_nodes_counted_in_several_passes_are_the_same(table):
    _, _, binned, _, _ = table
    whole = tr.Grower(binned, 3, 12, tr.Rules()).forest()[0]
    parts = tr.Grower(binned, 3, 12, tr.Rules(), cells=80).forest()[0]
    assert nodes_of(whole) == nodes_of(parts)
    with pytest.raises(ValueError, match="nodes"):
        tr.Grower(binned, 3, 12, tr.Rules(), max_nodes=3).forest()


def test_best_leaf_first_always_takes_the_largest_gain(table):
    _, _, binned, _, _ = table
    tree = tr.Grower(binned, 3, 12, tr.Rules("second_order", max_leaves=8, reg_lambda=1.0)).forest()[0]
    assert len(tree.leaves()) == 8
    whole = tr.Grower(binned, 3, 12, tr.Rules("second_order", max_depth=8, reg_lambda=1.0)).forest()[0]
    assert sum(tree.gain[i] for i in tree.reachable()) <= sum(whole.gain[i] for i in whole.reachable())


def test_edges(spark):
    rows = [([float(i), float(i % 3), 7.0, math.nan if i % 2 else 1.0],) for i in range(101)]
    df = spark.createDataFrame([(Vectors.dense(r[0]),) for r in rows], ["features"])
    edges = tr.bin_edges(df, 4, 4)
    assert edges == [[25.0, 50.0, 75.0], [0.5, 1.5], [], []]
    with pytest.raises(ValueError):
        tr.bin_edges(df, 4, 300)


def test_separable_rows_are_learned(spark):
    rows = [("a", [1.0, 0.0, 1.0], 0), ("b", [2.0, 0.0, 1.0], 0), ("c", [10.0, 1.0, 10.0], 1), ("d", [11.0, 1.0, 10.0], 1)]
    df = spark.createDataFrame([(k, Vectors.dense(x), y) for k, x, y in rows], ["key", "features", "label"])
    for learner in (tr.TreeLearner(tr.Rules()), tr.TreeLearner(tr.Rules(max_features="sqrt"), 5), tr.TreeLearner(tr.Rules("second_order", 2), 5, boosted=True, rate=0.5)):
        got = learner.fit(df).transform(df).select("label", "prediction").collect()
        assert all(r["label"] == r["prediction"] for r in got)


def test_exclusive_or_needs_a_split_without_gain(spark):
    rows = [(f"{a}{b}{i}", [float(a), float(b)], a ^ b) for a in (0, 1) for b in (0, 1) for i in range(5)]
    df = spark.createDataFrame([(k, Vectors.dense(x), y) for k, x, y in rows], ["key", "features", "label"])
    got = tr.TreeLearner(tr.Rules()).fit(df).transform(df).select("label", "prediction").collect()
    assert all(r["label"] == r["prediction"] for r in got)


def test_forest_draws_rows_and_features(table):
    df, edges, binned, x, y = table
    draw = tr.Draw(bootstrap=True, seed=3)
    made = tr.Grower(binned, 3, 12, tr.Rules(max_features=1, max_depth=3), draw).forest(4)
    again = tr.Grower(binned.repartition(5), 3, 12, tr.Rules(max_features=1, max_depth=3), draw).forest(4)
    assert [nodes_of(t) for t in made] == [nodes_of(t) for t in again]
    assert len({json.dumps(nodes_of(t)) for t in made}) > 1
    uid = np.array([r["uid"] for r in binned.select("uid").collect()])
    assert [t.n[0] for t in made] == [int((draw.counts(uid, k) > 0).sum()) for k in range(4)]
    counts = draw.counts(np.arange(200_000, dtype=np.int64) * 7919, 0)
    assert abs(counts.mean() - 1) < 0.01 and abs(counts.var() - 1) < 0.02
    share = tr.Draw(share=0.3).counts(np.arange(200_000, dtype=np.int64), 5)
    assert abs(share.mean() - 0.3) < 0.005


def test_boosting_follows_the_gradients(table):
    """Every tree of the sequence is the plain tree of the gradients at the margins before it; stored margins change nothing."""
    df, edges, binned, x, y = table
    rules = tr.Rules("second_order", 2, reg_lambda=2.0, reg_alpha=0.5, min_child_weight=1.0)
    learner = tr.TreeLearner(rules, tr.STORE_EVERY + 2, 12, boosted=True, rate=0.3)
    model = learner.fit(df)
    stage = model.stages[0]
    margin = np.zeros(len(y))
    for tree, values in zip(stage.trees(), stage.fitted()["values"], strict=True):
        p = 1 / (1 + np.exp(-margin))
        assert [n[:4] for n in nodes_of(tree)] == [n[:4] for n in plain_tree(x, p - y, p * (1 - p), rules)]
        for i, v in enumerate(values):
            g = math.copysign(max(abs(tree.a[i]) - 0.5, 0), tree.a[i])
            assert v == pytest.approx(-g / (tree.b[i] + 2.0))
        margin += 0.3 * np.array(values)[tr.walk(tr._arrays(tree), x)]
    got = {r["key"]: r["probability"][1] for r in model.transform(df).collect()}
    assert [got[f"k{i}"] for i in range(len(y))] == pytest.approx((1 / (1 + np.exp(-margin))).tolist())


def test_penalties_shrink_leaves(table):
    _, _, binned, _, _ = table
    largest = []
    for lam, alpha in ((0.0, 0.0), (5.0, 0.0), (50.0, 0.0), (50.0, 8.0)):
        rules = tr.Rules("second_order", 1, reg_lambda=lam, reg_alpha=alpha)
        tree = tr.Grower(binned, 3, 12, rules).forest()[0]
        largest.append(max(abs(tr.leaf_value(tree.a[i], tree.b[i], rules)) for i in tree.leaves()))
    assert largest == sorted(largest, reverse=True) and largest[0] > largest[-1]


def test_weakest_links(table):
    _, _, binned, x, y = table
    rules = tr.Rules()
    tree = tr.Grower(binned, 3, 12, rules).forest()[0]
    path = tr.pruning_path(tree, rules)
    assert [a for a, _, _ in path] == sorted(a for a, _, _ in path) and path[-1][1] == 1
    assert [n for _, n, _ in path] == sorted({n for _, n, _ in path}, reverse=True) and path[0][1] == len(tree.leaves())
    assert nodes_of(tr.pruned(tree, rules, 0.0)) == nodes_of(tree)

    def cost(t, alpha):
        """Impurity of the leaves plus alpha for each."""
        return sum(tr.loss(t.a[i], t.b[i], rules) / len(y) + alpha for i in t.leaves())

    def least(t, node, alpha):
        """Cheapest pruning of the subtree at ``node``, by trying both for every node."""
        own = tr.loss(t.a[node], t.b[node], rules) / len(y) + alpha
        return own if t.feature[node] < 0 else min(own, least(t, t.left[node], alpha) + least(t, t.right[node], alpha))

    for alpha in (0.001, 0.004, 0.01, 0.03, 0.2):
        assert cost(tr.pruned(tree, rules, alpha), alpha) == pytest.approx(least(tree, 0, alpha))
    assert len(tr.pruned(tree, rules, 10.0).leaves()) == 1


def test_saved_model_and_odd_rows(table, tmp_path):
    df, _, _, _, _ = table
    model = tr.TreeLearner(tr.Rules(max_depth=3), ccp_alpha=0.005).fit(df.withColumn("weight", F.lit(2.0)))
    model.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    assert sorted(again.transform(df).select("key", "prediction").collect()) == sorted(model.transform(df).select("key", "prediction").collect())
    nodes = model.stages[0].node_table(df.sparkSession)
    assert nodes.where("left = -1").agg(F.sum("n")).first()[0] == 160
    with pytest.raises(ValueError):
        tr.TreeLearner(tr.Rules()).fit(df.limit(0))
    single = tr.TreeLearner(tr.Rules()).fit(df.where("label = 1"))
    assert single.transform(df).select("prediction").distinct().collect() == [(1.0,)]


def test_catalogue_takes_the_parameters(table):
    """The live forest grid has 18 candidates that differ; small nodes stay whole in every one of them."""
    from riskloom.operators import models, search

    grid = {"model__n_estimators": [100, 200], "model__max_depth": [5, 10, 15], "model__min_samples_split": [2, 3, 4], "model__class_weight": ["balanced"]}
    kept, ignored = search.different_candidates(search.Experiment("RandomForest", None, "y", "id", grid))
    assert len(kept) == 18 and ignored == []
    df, _, _, _, _ = table
    shapes = set()
    for least in (2, 30, 60):
        fitted = models.fit_model("RandomForest", {"n_estimators": 3, "max_depth": 10, "min_samples_split": least, "class_weight": "balanced"}, df)
        for tree in fitted.stages[0].trees():
            assert all(tree.n[i] >= least for i, f in enumerate(tree.feature) if f >= 0)
        shapes.add(sum(len(t.feature) for t in fitted.stages[0].trees()))
    assert len(shapes) == 3
    tree = models.fit_model("DecisionTree", {"max_depth": 20, "min_samples_split": 20, "min_samples_leaf": 5, "max_features": "sqrt", "ccp_alpha": 0.01, "class_weight": "balanced"}, df).stages[0].trees()[0]
    assert all(tree.n[i] >= 5 for i in range(len(tree.feature)))
    light = models.fit_model("LightGBM", {"n_estimators": 2, "num_leaves": 5, "min_child_samples": 3}, df).stages[0].trees()
    assert [len(t.leaves()) for t in light] == [5, 5]
    with pytest.raises(ValueError):
        models.fit_model("LightGBM", {"num_leaves": 1}, df)


def test_rows_outside_the_draw_get_no_margin(monkeypatch):
    """Boosting on a share of the rows: margins, the dear part of a pass, are summed for the drawn rows only."""
    rng = np.random.default_rng(4)
    n, seen = 4000, []
    x = rng.integers(0, 6, (n, 3)).astype(np.uint8)
    uid = rng.integers(-(2**62), 2**62, n)
    packed = pa.array([r.tobytes() for r in x], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(uid), pa.array(x[:, 0] % 2.0), pa.array(np.ones(n)), packed, pa.array(np.zeros(n))], ["uid", "y", "w", "bins", "margin"])
    margins = tr._margins
    monkeypatch.setattr(tr, "_margins", lambda margin, *rest: seen.append(len(margin)) or margins(margin, *rest))
    tree = tr.Tree()
    tree.add(0)
    draw = tr.Draw(share=0.25)
    job = tr._Pass({0: tr._arrays(tree)}, {0: np.zeros(1, np.int32)}, 1, np.array([[0, 2]]), np.full(1, -1), 3, 6, draw, True, [])
    got = pa.Table.from_batches(list(tr._count(iter([batch.slice(0, 1500), batch.slice(1500)]), job))).to_pandas()
    held = draw.counts(uid, 0) > 0
    assert sum(seen) == held.sum() < n / 3
    for j in (0, 2):
        mine = got[got["feature"] == j].sort_values("bin")
        assert mine["n"].tolist() == np.bincount(x[held, j], minlength=6).tolist()
    assert set(got["feature"]) == {0, 2}


def test_a_pass_holds_cells_of_the_drawn_features_only(spark):
    """Nodes that may be split by two features of eight take a quarter of the cells, and the passes are fewer."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8))
    rows = [(str(i), Vectors.dense(x[i].tolist()), int(x[i, 0] * x[i, 1] + x[i, 2] > 0)) for i in range(600)]
    df = spark.createDataFrame(rows, ["key", "features", "label"])
    binned = tr.bin_rows(df, tr.bin_edges(df, 8, 8))
    rules = tr.Rules(max_depth=3, max_features="sqrt")
    few = tr.Grower(binned, 8, 8, rules, tr.Draw(bootstrap=True), cells=2 * 8 * 8)
    many = tr.Grower(binned, 8, 8, rules, tr.Draw(bootstrap=True))
    assert few.forest(4) == many.forest(4)
    assert many.passes == 3 and few.passes <= 4


@pytest.mark.parametrize("rules,share,columns", [(tr.Rules("second_order", 2, reg_lambda=4.0, reg_alpha=1.0, min_child_weight=1.0), 0.4, 0.7), (tr.Rules("second_order", max_leaves=6, reg_lambda=1.0, gamma=0.05), 1.0, 1.0)])
def test_boosting_over_patterns_is_boosting_over_rows(spark, monkeypatch, rules, share, columns):
    """Every tree and score is that of passes over the rows: draws are the rows' own, keys may repeat, weights differ, and a pattern may hold most rows."""
    rng = random.Random(8)
    rows = []
    for i in range(900):
        f = [0.0, 1.0, 0.0] if i % 2 else [float(rng.randrange(6)), float(rng.randrange(9)), float("nan") if i % 8 == 0 else float(rng.randrange(3))]
        rows.append((None if i % 90 == 0 else f"k{i // 2 if i < 100 else i}", Vectors.dense(f), float(rng.random() < 0.2 + f[0] / 10), 1.0 + i % 3))
    kinds = zip(("key", "features", "label", "weight"), (StringType(), VectorUDT(), DoubleType(), DoubleType()))
    df = spark.createDataFrame(rows, StructType([StructField(n, k) for n, k in kinds]))
    learner = tr.TreeLearner(rules, 11, 8, tr.Draw(share, seed=3), boosted=True, rate=0.4, columns=columns)
    passes = []
    tally = tr.Patterns.tallies
    monkeypatch.setattr(tr.Patterns, "tallies", lambda self, *a: passes.append(len(self.y)) or tally(self, *a))
    monkeypatch.setattr(tr, "TALLIES", 4 * 260)
    over_patterns = learner.fit(df)
    assert len(passes) == 1 and passes[0] < 900
    monkeypatch.setattr(tr, "PATTERNS", 20)
    over_rows = learner.fit(df)
    assert len(passes) == 1
    for a, b in zip(over_patterns.stages[0].trees(), over_rows.stages[0].trees(), strict=True):
        assert (a.feature, a.bin, a.left, a.right, a.n) == (b.feature, b.bin, b.left, b.right, b.n)
        for x, y in ((a.a, b.a), (a.b, b.b), (a.gain, b.gain)):
            assert x == pytest.approx(y, abs=1e-8)
    kept = [sorted(r["probability"][1] for r in over_patterns.transform(df).collect())]
    monkeypatch.setattr(tr, "SCORES", 0)
    kept.append(sorted(r["probability"][1] for r in over_patterns.transform(df).collect()))
    assert kept[0] == kept[1]


def test_the_second_order_fit_grows_all_its_trees():
    from riskloom.plans import catalog_trees

    assert catalog_trees.GROWN_FITS["fit_second_order"][1]["n_estimators"] == 200
