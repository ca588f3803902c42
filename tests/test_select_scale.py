import pytest
from pyspark.sql import functions as F

from riskloom.operators import select as sel


@pytest.fixture(scope="module")
def children(spark):
    auc, f1 = "cv_cand_test_roc_auc", "cv_cand_test_f1"
    rows = [
        ("b2", "p", {auc: 0.9}, True), ("b10", "p", {auc: 0.9}, True), ("a1", "p", {auc: 0.95}, False), ("c", "p", {f1: 1.0}, True),
        ("y", "q", {f1: 0.5, auc: None}, True), ("x", "q", {f1: float("nan")}, True),
        ("n2", "r", {"other": 1.0}, True), ("n1", "r", {}, True), (None, "s", {auc: 0.5}, True), ("s1", "s", {auc: 0.5}, True), ("t", "t", {auc: 0.4}, False),
    ]
    df = spark.createDataFrame(rows, "run_id string, parent_name string, metrics map<string,double>, gate_passes boolean")
    return df.withColumn("params", F.create_map(F.lit("model__k"), F.col("run_id")))


def test_winners_by_value_then_run_id(children):
    got = {r["parent_name"]: (r["child_run_id"], r["chosen_metric"], r["metric_value"]) for r in sel.winners(children).collect()}
    auc = "cv_cand_test_roc_auc"
    assert got == {"p": ("b10", auc, 0.9), "q": ("y", "cv_cand_test_f1", 0.5), "r": ("n1", None, None), "s": (None, auc, 0.5)}


def test_only_winning_rows_are_sorted_with_their_maps(children):
    plan = sel.winners(children)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("min_by") < plan.index("<=> _id")


def test_keys_are_cleaned_once_each(spark):
    names = ["model__classifier__x", "classifier__model__x", "param_x", "a::b", "grid_y", "search_z", "q"]
    given = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.concat(F.col("id").cast("string"), F.lit(i)) for i in range(len(names))]))
    df = spark.range(2).select(sel.clean_params(F.when(F.col("id") == 0, given)).alias("p"))
    assert sorted((r["p"] for r in df.collect()), key=lambda p: p is not None) == [None, {"x": "02", "model__x": "01", "q": "06"}]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_children_are_not_dealt_out_by_parent(spark):
    """Few parents with many children each: a shuffle by parent would put them into a few tasks."""
    runs = spark.range(300).select(
        F.concat(F.lit("c"), "id").alias("run_id"), F.when(F.col("id") > 1, F.concat(F.lit("c"), F.col("id") % 2)).alias("parent_id"),
        F.concat(F.lit("n"), F.col("id") % 2).alias("run_name"), F.create_map(F.lit("gate_passes"), F.lit("True")).alias("tags"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = sel.name_children(runs)
        assert named.where("gate_passes AND parent_name = 'n' || substr(parent_id, 2)").count() == 298
        assert "SortMergeJoin" not in named._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
