import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics as m
from riskloom.operators import select as sel

CASES = {
    "perfect": ([0, 1, 0, 1], [0, 1, 0, 1], [0.1, 0.9, 0.2, 0.8], (1, 1, 1, 1, 1)),
    "awful": ([0, 1, 0, 1], [1, 0, 1, 0], [0.9, 0.1, 0.8, 0.2], (0, 0, 0, 0, 0)),
    "mixed": ([0, 1, 0, 1, 0, 0], [0, 1, 1, 0, 0, 0], [0.1, 0.9, 0.7, 0.3, 0.2, 0.4], (4 / 6, 0.5, 0.5, 0.5, 0.75)),
    "all_negative": ([0] * 9 + [1], [0] * 10, [0.1] * 9 + [0.2], (0.9, 0, 0, 0, 1)),
}


def scored(spark, cases=CASES):
    rows = [(name, t, p, s) for name, (ys, ps, ss, _) in cases.items() for t, p, s in zip(ys, ps, ss)]
    return spark.createDataFrame(rows, "name string, y_true int, y_pred int, y_prob double")


def test_golden_cases(spark):
    got = {r["name"]: r for r in m.classification_metrics(scored(spark), ["name"]).collect()}
    for name, (_, _, _, want) in CASES.items():
        r = got[name]
        assert (r["accuracy"], r["precision"], r["recall"], r["f1"], r["roc_auc"]) == pytest.approx(want)
    mixed = m.confusion_matrix(scored(spark).where("name = 'mixed'")).first()[0]
    assert mixed == [[3, 1], [1, 1]]


def test_hold_out_report_figures(spark):
    """Rates that follow from the counts 100, 38, 16, 45."""
    cells = spark.createDataFrame([(100, 38, 16, 45)], "tn bigint, fp bigint, fn bigint, tp bigint")
    r = m.with_rates(cells).first()
    want = (0.7286432160804021, 0.5421686746987951, 0.7377049180327869, 0.625, 0.7311421073793923)
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"], r["gmean"]) == pytest.approx(want, rel=1e-12)


def test_no_probability_and_single_class(spark):
    df = scored(spark)
    assert "roc_auc" not in m.classification_metrics(df, ["name"], score=None).columns
    one = df.where("y_true = 0")
    assert all(r["roc_auc"] is None for r in m.classification_metrics(one, ["name"]).collect())


def test_roc_curve_ends_at_one(spark):
    rows = m.roc_curve(scored(spark).where("name = 'mixed'")).orderBy(F.desc("threshold")).collect()
    assert (rows[-1]["fpr"], rows[-1]["tpr"]) == (1.0, 1.0)
    assert (rows[0]["threshold"], rows[0]["tpr"]) == (0.9, 0.5)


def test_report_has_averages(spark):
    rep = {r["class"]: r for r in m.classification_report(scored(spark).where("name = 'mixed'")).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rep["weighted avg"]["recall"] == pytest.approx(4 / 6)


def test_cv_summary_skips_nan(spark):
    df = spark.createDataFrame([("a", "f1", 0.5), ("a", "f1", float("nan")), ("a", "f1", 0.7)], "model string, metric string, value double")
    r = m.cv_summary(df, ["model"]).first()
    assert (r["mean"], r["std"]) == pytest.approx((0.6, 0.1))
    assert r["text"] == "0.6000 (±0.100)"


def test_estimated_counts(spark):
    rows = [(0.5, 0.5), (0.0, 0.3), (1.0, 1.0), (None, 0.2), (0.01, 1.0)]
    df = spark.createDataFrame(rows, "precision double, recall double")
    got = [tuple(r[c] for c in ("tn", "fp", "fn", "tp")) for r in m.estimate_confusion(df, F.lit(61), F.lit(138)).collect()]
    # half counts go to the even neighbour: 30.5 hits become 30
    assert got == [(108, 30, 31, 30), (0, 138, 43, 18), (138, 0, 0, 61), (0, 138, 0, 61)]


def gates(spark, rows):
    cols = "candidate int, mean_train_roc_auc double, mean_test_roc_auc double, mean_train_f1 double, mean_test_f1 double"
    return sel.with_gates(spark.createDataFrame(rows, cols))


def test_gates(spark):
    rows = [(0, 0.8, 0.78, 0.6, 0.58), (1, 0.9, 0.78, 0.6, 0.58), (2, 0.6, 0.6, 0.6, 0.6), (3, 0.71, 0.69, 0.6, 0.6), (4, 0.8, 0.78, 0.6, 0.59)]
    got = {r["candidate"]: (r["gate_underfit"], r["gate_overfit"], r["gate_passes"]) for r in gates(spark, rows).collect()}
    assert got == {0: (False, False, True), 1: (False, True, False), 2: (True, False, False), 3: (False, False, False), 4: (False, False, True)}
    best = sel.best_passing(gates(spark, rows).withColumn("g", F.lit("x")), "g").first()
    assert best["candidate"] == 4


def test_names_and_params(spark):
    names = {
        "RandomForest + SMOTE v2__GRID": ("rf", "rf"), "team-LogReg-SMOTE-v2": ("lr", "lr"), "random forest 3": ("rf", "x"),
        "SVC + SMOTE v2__GRID": ("svc", "svc"), "kneighbors": ("knn", "x"), "Decision tree": ("dt", "x"), "mystery": (None, "x"), "xgb2": ("xgb", "xgb"),
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: (r["f"], r["k"]) for r in df.select("n", sel.model_family(F.col("n")).alias("f"), sel.registry_key(F.col("n")).alias("k")).collect()}
    assert got == names
    params = spark.createDataFrame([({"best::C": "1", "model__C": "2"},), ({"model__b": "x", "z": "1", "model__a": "y"},), ({"q": "1"},), ({},)], "p map<string,string>")
    text = [r[0] for r in params.select(sel.params_text(sel.chosen_params(F.col("p")))).collect()]
    assert text == ["C=1", "model__a=y, model__b=x", "q=1", ""]
    typed = spark.createDataFrame([({"model__C": "1", "param_C": "2.50", "cand::x": "1", "grid_C": "[1]"},)], "p map<string,string>")
    assert typed.select(sel.typed_params(F.col("p"))).first()[0] == {"C": ("float", "2.5")}
    flags = spark.createDataFrame([("True",), ("1",), (" yes",), ("no",), (None,)], "t string")
    assert [r[0] for r in flags.select(sel.flag(F.col("t"))).collect()] == [True, True, True, False, False]


def test_keyword_metric_prefers_test(spark):
    df = spark.createDataFrame([({"train f1": 0.9, "test f1": 0.4, "Recall": 0.3, "cv_cand_train_precision": 0.2},)], "m map<string,double>")
    r = df.select(*[sel.metric_by_keyword(F.col("m"), k).alias(k) for k in ("f1", "recall", "precision", "accuracy")]).first()
    assert r == (0.4, 0.3, 0.2, None)


def test_champion_needs_a_run(spark):
    df = spark.createDataFrame([("r1", {"a": 1.0}), ("r2", {"a": 2.0}), ("r3", {"b": math.pi})], "run_id string, metrics map<string,double>")
    assert sel.champion(df, "a")["run_id"] == "r2"
    with pytest.raises(ValueError):
        sel.champion(df, "missing")
