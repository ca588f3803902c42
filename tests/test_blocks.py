"""Distributed building blocks against brute force."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom import runtime
from riskloom.functions import ordering, tails
from riskloom.functions.hashing import draw_hash, hash_cutoffs, normal, uniform
from riskloom.operators import metrics, neighbors, split


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.RandomState(3)
    x = np.concatenate([rng.lognormal(size=700), np.full(400, 2.5), rng.randint(0, 5, size=300)])
    rows = [(i, float(v), int(i % 7 == 0), "h" if i % 3 else f"k{i}") for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id int, x double, y int, s string"), x


def test_running_totals_bucketed(numbers, monkeypatch):
    df, x = numbers
    monkeypatch.setattr(ordering, "ONE_TASK_ROWS", 10)
    g = df.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    got = {r["x"]: r["cum_n"] for r in ordering.running_totals(g, [], "x", ["n"], 8).collect()}
    assert got == {v: int((x <= v).sum()) for v in set(x.tolist())}


def test_running_totals_by_group_and_text(numbers, monkeypatch):
    df, x = numbers
    monkeypatch.setattr(ordering, "ONE_TASK_ROWS", 10)
    got = {(r["y"], r["x"]): r["cum_n"] for r in ordering.running_totals(df.groupBy("y", "x").agg(F.count("id").alias("n")), ["y"], "x", ["n"], 8).collect()}
    pdf = df.toPandas()
    for (y, v), n in got.items():
        assert n == ((pdf.y == y) & (pdf.x <= v)).sum()
    index = {r["s"]: r["i"] for r in ordering.ordered_index(df, "s", "i").collect()}
    assert index == {s: i for i, s in enumerate(sorted(set(pdf.s)))}


def test_row_numbers(numbers, monkeypatch):
    df, _ = numbers
    monkeypatch.setattr(ordering, "ONE_TASK_ROWS", 10)
    rows = ordering.row_numbers(df.select((F.col("id") * 3).alias("id")), "id", buckets=8).collect()
    assert all(r["row_number"] == r["id"] // 3 + 1 for r in rows)


@pytest.mark.parametrize("n", [0, 1, 50, 701, 900, 1400, 5000])
def test_take_smallest_is_exact(numbers, n):
    df, x = numbers
    got = sorted(r["x"] for r in ordering.take_smallest(df, n, "x", "id").collect())
    assert got == sorted(x.tolist())[:n]


def test_take_largest(numbers):
    df, x = numbers
    got = sorted(r["x"] for r in ordering.take_smallest(df, 33, "x", "id", largest=True).collect())
    assert got == sorted(x.tolist())[-33:]


def test_exact_quantiles(numbers):
    df, x = numbers
    probs = [0.0, 0.1, 0.25, 0.5, 0.333, 0.75, 0.99, 1.0]
    got = ordering.exact_quantiles(df.withColumn("none", F.lit(None).cast("double")), ["x", "none", "y"], probs)
    for p in probs:
        assert got[("x", p)] == pytest.approx(np.quantile(x, p), rel=1e-12)
        assert got[("none", p)] is None


def test_cutoffs_and_draws(spark):
    df = spark.range(5000).withColumn("s", (F.col("id") % 3 == 0).cast("int"))
    digest = draw_hash(9, F.col("id"))
    cut = hash_cutoffs(df, "s", digest, {0: [1, 100], 1: [777]})
    h = df.withColumn("h", digest)
    assert h.where((F.col("s") == 0) & (F.col("h") <= cut[(0, 100)])).count() == 100
    assert h.where((F.col("s") == 0) & (F.col("h") <= cut[(0, 1)])).count() == 1
    assert h.where((F.col("s") == 1) & (F.col("h") <= cut[(1, 777)])).count() == 777
    r = h.agg(F.avg(uniform(F.col("h"))), F.avg(normal(F.col("h"))), F.stddev(normal(F.col("h")))).first()
    assert abs(r[0] - 0.5) < 0.02 and abs(r[1]) < 0.05 and abs(r[2] - 1) < 0.05


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 6), st.integers(1, 500), min_size=1), st.floats(0.01, 0.99))
def test_share_out(counts, share):
    total = math.ceil(sum(counts.values()) * share)
    out = split.share_out(counts, total)
    assert sum(out.values()) == total
    assert all(abs(out[s] - total * c / sum(counts.values())) < 1 for s, c in counts.items())


def test_split_and_folds_do_not_depend_on_partitions(spark):
    df = spark.range(997).withColumn("y", (F.col("id") % 10 < 3).cast("int"))
    a = split.stratified_split(df, "y", "id").collect()
    b = split.stratified_split(df.repartition(7), "y", "id").collect()
    assert sorted(a) == sorted(b)
    assert sum(r["split"] == "test" for r in a) == 200
    sizes = split.stratified_folds(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r["y"] == y]
        assert len(n) == 5 and max(n) - min(n) <= 1
    many = spark.range(600).withColumn("c", F.col("id") % 60)
    per = split.stratified_folds(many, "c", "id", 2).groupBy("c", "fold").count().collect()
    assert len(per) == 120 and all(r["count"] == 5 for r in per)


def test_auc_is_invariant_to_monotone_scores(spark):
    rng = np.random.RandomState(1)
    rows = [(int(a), float(b)) for a, b in zip(rng.randint(0, 2, 500), rng.randint(0, 40, 500))]
    df = spark.createDataFrame(rows, "y_true int, y_prob double")
    a = metrics.roc_auc(df).first()[0]
    b = metrics.roc_auc(df.withColumn("y_prob", F.exp(F.col("y_prob") / 7))).first()[0]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert a == pytest.approx(b) == pytest.approx(brute)


def test_bounded_collect_and_attach(spark):
    df = spark.range(10)
    assert runtime.collect_bounded(df, 9) is None
    assert len(runtime.collect_bounded(df, 10)) == 10
    side = spark.range(5).withColumn("v", F.col("id") * 2)
    for limit in (3, 100):
        out = runtime.attach_small(df, side, ["id"], limit=limit).collect()
        assert {r["id"]: r["v"] for r in out} == {i: (2 * i if i < 5 else None) for i in range(10)}


def test_scratch_needs_a_shared_folder(spark, tmp_path):
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert runtime.scratch_root(spark)
    assert old is None or runtime.scratch_root(spark) == old


# probabilities published for two samples of equal size, recomputed from size and largest gap
@pytest.mark.parametrize(
    "n,gap,p",
    [
        (193, 28, 0.0342939330446569),
        (193, 40, 0.00048300270080164475),
        (194, 47, 2.0866855903468888e-05),
        (193, 110, 2.8227321937718625e-29),
        (194, 42, 0.00021431310439066315),
        (192, 98, 3.842993717715091e-23),
    ],
)
def test_exact_ks_probability(n, gap, p):
    assert tails.ks_exact(gap / n, n, n) == pytest.approx(p, rel=1e-9)


def test_other_tails():
    assert tails.ks_limit(0.02, 10**6, 10**6) == pytest.approx(0.0, abs=1e-12)
    assert tails.ks_exact(0.05, 3000, 2500) == pytest.approx(tails.ks_limit(0.05, 3000, 2500), rel=0.05)
    assert tails.chi_square_upper(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert tails.chi_square_upper(9.487729036781154, 4) == pytest.approx(0.05, abs=1e-9)
    assert tails.chi_square_upper(float("inf"), 4) == 0.0
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-9)
    assert tails.chi_square_upper(1_000_000.0, 1_000_000) == pytest.approx(0.5, abs=1e-3)
    assert tails.chi_square_upper(30.0, 3) == pytest.approx(1.380057e-06, rel=1e-5)
    assert tails.chi_square_upper(0.5, 3) == pytest.approx(0.918891, abs=1e-6)


def test_ks_method_is_asked_for():
    assert tails.ks_two_sided(0.3, 40, 40) == tails.ks_limit(0.3, 40, 40)
    assert tails.ks_two_sided(0.3, 40, 40, "exact") == tails.ks_exact(0.3, 40, 40)
    with pytest.raises(ValueError):
        tails.ks_two_sided(0.3, 40, 40, "auto")


def test_distances_to_pivots_leave_no_cell_out():
    rng = np.random.default_rng(8)
    for shift, scale in ((0.0, 1.0), (1e6, 1.0), (0.0, 1e-12), (-3.0, 1e160)):
        pivots = (rng.normal(size=(40, 30)) + shift) * scale
        x = np.vstack([pivots[:5], (rng.normal(size=(20, 30)) + shift) * scale])
        cells = neighbors.Cells(pivots, np.ones(40), np.ones(40, dtype=int), np.arange(40))
        with np.errstate(over="ignore"):
            true = neighbors._distances(x, pivots, "l2")
            near, far = cells._to_pivots(x, "l2", False), cells._to_pivots(x, "l2", True)
        assert (near <= true * (1 + 1e-12)).all() and (far >= true * (1 - 1e-12)).all()
        if shift < 10:
            assert np.allclose(near, true, rtol=1e-6, atol=1e-5 * scale) and np.allclose(far, true, rtol=1e-6, atol=1e-5 * scale)
    x[0, 0] = np.inf
    assert np.isinf(cells._to_pivots(x, "l2", False)[0]).all()


def test_distances_to_pivots_come_from_a_product(monkeypatch):
    rng = np.random.default_rng(9)
    cells = neighbors.Cells(rng.normal(size=(40, 30)), np.ones(40), np.ones(40, dtype=int), np.arange(40))
    monkeypatch.setattr(neighbors, "_distances", None)  # one pass per dimension
    found = list(cells.within(rng.normal(size=(7, 30)), np.full(7, np.inf), "l2", False))
    assert [x.tolist() for x in found] == [list(range(40))] * 7
