import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, neighbors, sampling
from riskloom.operators.drift import CHI_NAME, KS_NAME, SEVERITY, Z_NAME


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.RandomState(5)
    x = np.round(rng.normal(size=(160, 3)), 2)
    x[40:90] = x[40]  # a large group of equal rows
    rows = [(f"r{i:03d}", int(i % 8 == 0), [float(v) for v in x[i]]) for i in range(160)]
    return spark.createDataFrame(rows, "id string, y int, vec array<double>"), x, [r[0] for r in rows]


@pytest.mark.parametrize("metric", ["l2", "l1"])
@pytest.mark.parametrize("farthest", [False, True])
@pytest.mark.parametrize("block,pivots", [(2048, None), (17, 9)])
def test_neighbours_match_brute_force(cloud, metric, farthest, block, pivots):
    df, x, ids = cloud
    got = {}
    for r in neighbors.nearest_neighbors(df, df, 4, metric=metric, farthest=farthest, skip_self=True, block_rows=block, pivots=pivots).collect():
        got[(r["query_id"], r["rank"])] = r["neighbor_id"]
    gap = x[:, None] - x[None]
    d = np.abs(gap).sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))
    for i in range(len(x)):
        order = sorted((j for j in range(len(x)) if j != i), key=lambda j: ((-1 if farthest else 1) * d[i, j], ids[j]))[:4]
        assert [got[(ids[i], r + 1)] for r in range(4)] == [ids[j] for j in order]


def test_fewer_rows_than_neighbours(cloud):
    df, _, _ = cloud
    few = df.where("id < 'r003'")
    assert neighbors.nearest_neighbors(few, few, 5, skip_self=True).count() == 6
    assert neighbors.nearest_neighbors(few, df.limit(0), 5).count() == 0


def test_smote_ratio_and_segments(cloud):
    df, x, ids = cloud
    out = sampling.smote(df, "y", "id", k=3, ratio=0.7)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 140, 1: 98}
    assert out.select("id").distinct().count() == 238
    few = x[[i for i in range(160) if i % 8 == 0]]
    made = np.array([r["vec"] for r in out.where(F.contains("id", F.lit("~"))).collect()])
    assert len(made) == 78
    assert (made >= few.min(0) - 1e-9).all() and (made <= few.max(0) + 1e-9).all()
    again = sampling.smote(df.repartition(5), "y", "id", k=3, ratio=0.7).collect()
    assert sorted(map(str, again)) == sorted(map(str, out.collect()))


@pytest.mark.parametrize("version", [1, 2, 3])
def test_near_miss_balances(cloud, version):
    df, _, _ = cloud
    out = {r["y"]: r["count"] for r in sampling.near_miss(df, "y", "id", version=version).groupBy("y").count().collect()}
    assert out[1] == 20 and (out[0] == 20 if version != 3 else out[0] <= 20)


def test_unknown_sampler():
    with pytest.raises(ValueError):
        sampling.sampler_by_name("Magic")
    assert sampling.sampler_by_name(None) is sampling.no_sampling


def people(spark, n=400):
    rows = [(i, float(i % 97), "abc"[i % 3], i % 4, i % 2, 5.0) for i in range(n)]
    return spark.createDataFrame(rows, "id int, x double, s string, q int, t int, flat double")


def test_same_table_has_no_drift(spark):
    df = people(spark)
    rep = {r["column"]: r for r in drift.drift_report(df.drop("id"), df.drop("id"), target="t").collect()}
    assert {c: r["stattest"] for c, r in rep.items()} == {"x": KS_NAME, "s": CHI_NAME, "q": CHI_NAME, "t": Z_NAME, "flat": Z_NAME}
    assert all(r["drift_score"] == pytest.approx(1.0) and not r["drift_detected"] for r in rep.values())
    assert rep["t"]["column_type"] == "cat"
    assert len(rep["x"]["current"]["x"]) == 11 and len(rep["x"]["current"]["y"]) == 10


def test_shapes_of_any_number_of_values(spark):
    df = spark.createDataFrame([(f"v{i % 1500}", float(i)) for i in range(3000)], "s string, x double")
    report, shapes = drift.drift_report_and_shapes(df, df.where("s <> 'v7'"))
    assert report.count() == 2
    seen = {(r["side"], r["label"]): r["y"] for r in shapes.where("column = 's'").collect()}
    assert len(seen) == 3000 and seen[("reference", "v7")] == 2.0 and seen[("current", "v7")] == 0.0
    assert shapes.where("column = 'x'").count() == 20


def test_reference_is_counted_once(spark):
    df = people(spark).drop("id")
    moved = df.withColumn("x", F.col("x") + 30)
    plain = sorted(drift.drift_report(df, moved, "t", with_density=False).collect())
    counted = drift.reference_counts(df, "t")
    assert sorted(drift.drift_report(df.limit(0), moved, "t", with_density=False, counted=counted).collect()) == plain


def test_injection_changes_only_what_it_may(spark):
    df = people(spark)
    out, log = drift.inject_drift(df, "id", 0.5, 42, target="t", exclude=["q"])
    assert {r["column"] for r in log.collect()} == {"x", "s"}
    both = df.alias("a").join(out.alias("b"), "id")
    assert both.where("a.q <> b.q OR a.t <> b.t OR a.flat <> b.flat").count() == 0
    way = {r["column"]: r["direction"] for r in log.collect()}["x"]
    signs = both.agg(F.min(F.expr("b.x - a.x")), F.max(F.expr("b.x - a.x"))).first()
    assert (signs[0] >= 0) if way == "subir" else (signs[1] <= 0) if way == "bajar" else (signs[0] < 0 < signs[1])
    again, _ = drift.inject_drift(df.repartition(3), "id", 0.5, 42, target="t", exclude=["q"])
    assert sorted(out.collect()) == sorted(again.collect())
    rep = drift.drift_report(df.drop("id"), out.drop("id"), "t", with_density=False)
    assert {r["column"] for r in rep.where("drift_detected").collect()} >= {"s"}


def test_many_categories_take_the_interval_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"v{i % 120}", 1) for i in range(600)], "id int, s string, k int")
    a = sorted(drift.inject_drift(df, "id", exclude=["k"])[0].collect())
    monkeypatch.setattr(drift, "INLINE_VALUES", 10)
    b = sorted(drift.inject_drift(df, "id", exclude=["k"])[0].collect())
    assert a == b and len(b) == 600


def test_severity_levels(spark):
    shares = [0.0, 0.1, 0.2, 0.49, 0.5, 1.0]
    level, action = drift.severity(F.col("s"))
    got = spark.createDataFrame([(s,) for s in shares], "s double").select(level, action).collect()
    assert [tuple(r) for r in got] == [SEVERITY[i] for i in (0, 1, 2, 2, 3, 3)]


def test_monitor_appends(spark, tmp_path):
    df = people(spark).drop("id")
    log = str(tmp_path / "log")
    drift.monitor(df, df, log, "same")
    moved = df.withColumn("x", F.col("x") + 30)
    row = drift.monitor(df, moved, log, "moved").first()
    assert row["drifted_columns"] == 1 and row["top_columns_drift"] == "x"
    for _ in range(2):
        drift.monitor(df, moved, f"{tmp_path}/again/batch=0", "batch-0", mode="overwrite")
    assert spark.read.parquet(f"{tmp_path}/again").count() == 1
    stored = spark.read.parquet(log).orderBy("timestamp").collect()
    assert [r["top_columns_drift"] for r in stored] == ["Ninguna", "x"]
