import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.config import FeatureSpec
from riskloom.operators import features as fe
from riskloom.operators import models as mo
from riskloom.operators import search as se
from riskloom.operators.score import label_predictions
from riskloom.sources import models as store

SPEC = FeatureSpec(numeric=("n1", "n2"), nominal=("c1", "c2"), ordinal=("o1",))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.RandomState(0)
    out = []
    for i in range(240):
        y = int(i % 4 == 0)
        out.append((i, None if i % 29 == 0 else float(rng.normal(3 * y, 1)), float(rng.exponential(1 + y)), "AB"[int(rng.rand() < 0.5)],
                    None if i % 31 == 0 else float(rng.randint(1, 4)), float(rng.randint(1, 4)), y))
    return spark.createDataFrame(out, "id int, n1 double, n2 double, c1 string, c2 double, o1 double, y int")


def test_binary_encoder_width(spark):
    df = spark.createDataFrame([("1",), ("2",), ("1",), ("A",), (None,)], "col string")
    text = fe.TextCast(inputCols=["col"], outputCols=["t"]).transform(df)
    model = fe.BinaryEncoder(inputCols=["t"], outputCols=["col"]).fit(text)
    out = model.transform(text)
    assert model.output_names() == ["col_0", "col_1", "col_2"]
    got = [tuple(r) for r in out.select("t", "col_0", "col_1", "col_2").distinct().orderBy("t").collect()]
    assert got == [("1", 0, 0, 1), ("2", 0, 1, 0), ("A", 0, 1, 1), ("nan", 1, 0, 0)]
    new = model.transform(spark.createDataFrame([("Z",)], "t string"))
    assert tuple(new.select("col_0", "col_1", "col_2").first()) == (0, 0, 0)


def test_median_mode_and_scales(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "a"), (4.0, "b"), (None, None)], "x double, s string")
    med = fe.ValueImputer(inputCols=["x"], outputCols=["x"], option="median").fit(df).transform(df)
    assert [r["x"] for r in med.collect()][-1] == 2.5
    mode = fe.ValueImputer(inputCols=["s"], outputCols=["s"], option="most_frequent").fit(df).transform(df)
    assert [r["s"] for r in mode.collect()][-1] == "a"
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r[0] for r in fe.UnitScaler(inputCols=["x"], outputCols=["x"]).fit(flat).transform(flat).collect()] == [0.0, 0.0]
    pair = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert [r[0] for r in fe.ZScaler(inputCols=["x"], outputCols=["x"]).fit(pair).transform(pair).collect()] == [-1.0, 1.0]


def test_power_transform_finds_the_peak(spark):
    rng = np.random.RandomState(2)
    x = rng.lognormal(0, 0.7, 800)
    x = (x - x.min()) / (x.max() - x.min())
    lam = fe.fit_lambdas(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"])[0]

    def score(a):
        t = np.log1p(x) if a == 0 else ((x + 1) ** a - 1) / a
        return -len(x) / 2 * np.log(t.var()) + (a - 1) * np.log1p(x).sum()

    best = max(np.linspace(lam - 1, lam + 1, 20001), key=score)
    assert lam == pytest.approx(best, abs=2e-4)


def test_unknown_codes(spark):
    fit, new = spark.createDataFrame([(10.0,), (9.0,), (2.0,)], "o double"), spark.createDataFrame([(2.0,), (10.0,), (7.0,), (None,)], "o double")
    soft = fe.OrdinalIndex(inputCols=["o"], outputCols=["i"]).fit(fit)
    assert [r["i"] for r in soft.transform(new).collect()] == [0.0, 2.0, -1.0, -1.0]
    hard = fe.OrdinalIndex(inputCols=["o"], outputCols=["i"], option="error").fit(fit)
    with pytest.raises(PySparkException):
        hard.transform(new).collect()


@pytest.mark.parametrize("variant,width", [("live", 2 + 2 + 2 + 1), ("notebook", 7), ("extended", 2 + 1 + 2 + 3)])
def test_preprocessor(rows, variant, width):
    out = fe.build_preprocessor(SPEC, variant).fit(rows).transform(rows)
    assert out.columns == [*rows.columns, "features"]
    assert fe.width_report(rows, out, 5).first()["columns_after"] == width
    assert out.where(F.exists(vector_to_array("features"), lambda v: v.isNull() | F.isnan(v))).count() == 0


def test_separable_rows_are_learned(spark):
    rows = [(1, 1.0, 1.0, "A", "A", 1.0, 0), (2, 2.0, 2.0, "A", "A", 1.0, 0), (3, 10.0, 10.0, "B", "B", 10.0, 1), (4, 11.0, 11.0, "B", "B", 10.0, 1)]
    df = spark.createDataFrame(rows, "id int, n1 double, n2 double, c1 string, c2 string, o1 double, y int")
    exp = se.Experiment("LogisticRegression", SPEC, "y", "id")
    scored = se.score_labelled(se.fit_final(df, exp), df, exp).collect()
    assert all(r["y_true"] == r["y_pred"] for r in scored)


def test_catalogue_names():
    assert type(mo.build_estimator("LogisticRegression")).__name__ == "LogisticRegression"
    assert type(mo.build_estimator("RandomForest", {"max_depth": None})).__name__ == "RandomForestClassifier"
    assert type(mo.build_estimator("XGBoost", {"max_depth": 3})).__name__ == "GBTClassifier"
    with pytest.raises(KeyError):
        mo.build_estimator("Unheard")
    used, ignored = mo.split_params("lr", {"model__C": 1, "model__solver": "saga"})
    assert used == {"C": 1} and ignored == ["solver"]


@pytest.mark.parametrize("model,params", [("LogisticRegression", {"penalty": "l1", "C": 1.0, "class_weight": "balanced"}), ("AdaBoost", {"n_estimators": 3}), ("SVC", {"n_components": 20}), ("KNN", {"n_neighbors": 5, "p": 1})])
def test_fit_save_load_score(spark, rows, tmp_path, model, params):
    exp = se.Experiment(model, SPEC, "y", "id", variant="extended")
    fitted = se.fit_final(rows, exp, params)
    path = str(tmp_path / "m")
    store.save_model(fitted, path, rows.select(*SPEC.columns))
    loaded = store.load_model(spark, str(tmp_path / "absent"), fallback=path)
    a = sorted(se.score_labelled(fitted, rows, exp).collect())
    b = sorted(se.score_labelled(loaded, rows, exp).collect())
    assert a == b and len(a) == 240
    assert all(0 <= r["y_prob"] <= 1 for r in a)
    assert sum(r["y_true"] == r["y_pred"] for r in a) > 180
    fields, example = store.load_signature(spark, f"{path}/signature")
    assert fields.count() == 5 and example.count() == 5
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, str(tmp_path / "absent"))


def test_grid_search_with_resampling(spark, rows):
    exp = se.Experiment("LogisticRegression", SPEC, "y", "id", {"C": [0.01, 1.0]}, "SMOTE", {"k_neighbors": 3}, "extended")
    found = se.grid_search(rows, exp, k=2, refit=True, gates={"max_gap_auc": 1.0, "max_gap_f1": 1.0})
    table = found.results.collect()
    assert len(table) == 2 and all(0.5 < r["mean_test_roc_auc"] <= 1 for r in table)
    assert found.best_score == max(r["mean_test_roc_auc"] for r in table)
    assert found.passing_index is not None
    assert [r["parent_id"] is None for r in found.runs] == [True, False, False]
    assert se.score_labelled(found.model, rows, exp).count() == 240


def test_one_bad_candidate_does_not_stop_the_rest(rows):
    exp = se.Experiment("DecisionTree", SPEC, "y", "id", variant="extended")
    scored = se.cross_validate(rows, exp, [{"max_depth": 2}, {"max_depth": -5}], k=2, with_train=False)
    assert scored.select("candidate").distinct().collect() == [(0,)]
    assert scored.count() == 240
    with pytest.raises(RuntimeError):
        se.cross_validate(rows, exp, [{"max_depth": -5}], k=2)


def test_labels(spark):
    df = spark.createDataFrame([(1, 1.0, [0.2, 0.8]), (2, 0.0, [0.7, 0.3])], "id int, prediction double, probability array<double>")
    assert label_predictions(df, ["id"]).collect() == [(1, "Riesgo Alto", 1, 0.8), (2, "Riesgo Bajo", 0, 0.7)]
    assert label_predictions(df.drop("probability"), ["id"]).collect() == [(1, "Riesgo Alto", 1, 1.0), (2, "Riesgo Bajo", 0, 0.0)]


def test_candidates_with_missing_folds_get_no_mean(spark):
    rows = [(c, 0, f, s, 0.5 + c / 10) for c in (0, 1) for f in (0, 1) for s in ("test", "train") if not (c == 1 and f == 1)]
    df = spark.createDataFrame(rows, "candidate int, repeat int, fold int, side string, roc_auc double")
    got = {r["candidate"]: (r["folds"], r["mean_test_roc_auc"]) for r in se.cv_results(df, [{}, {}], ["roc_auc"]).collect()}
    assert got == {0: (2, 0.5), 1: (1, None)}


def test_nan_is_missing(spark):
    from riskloom.operators import profile

    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert [r["nulls"] for r in profile.null_counts(df).collect()] == [2]
    row = profile.describe_numeric(df, ["x"]).first().asDict()
    assert row["count"] == 2 and row["mean"] == 2.0


def test_a_failed_fold_is_not_passed_over(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i), "A" if i % 2 else "B", float(i % 3), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, n1 double, n2 double, c1 string, o1 double, y int")
    spec = FeatureSpec(numeric=("n1", "n2"), nominal=("c1",), ordinal=("o1",))
    exp = se.Experiment("LogisticRegression", spec, "y", "id")
    true_fit, calls = se.fit_model, []

    def fails_once(name, params, train, seed):
        calls.append(params)
        if params.get("C") == 0.5 and sum(p.get("C") == 0.5 for p in calls) == 2:
            raise ValueError("planted")
        return true_fit(name, params, train, seed)

    monkeypatch.setattr(se, "fit_model", fails_once)
    with pytest.raises(RuntimeError, match="planted"):
        se.out_of_fold(df, exp, {"C": 0.5}, k=3)
    calls.clear()
    scored = se.cross_validate(df, exp, [{"C": 0.5}, {"C": 1.0}], 3, 1, with_train=False)
    assert [(r["candidate"], r["count"]) for r in scored.groupBy("candidate").count().collect()] == [(1, 60)]
    calls.clear()
    exp.param_grid = {"C": [0.5, 1.0]}
    found = se.grid_search(df, exp, k=3, refit=False)
    assert found.best_params == {"C": 1.0}
    assert [r["tags"]["error"] for r in found.runs if r["tags"].get("status") == "FAILED"][0].endswith("planted")


def test_equal_candidates_are_fitted_once():
    grid = {"model__n_estimators": [5, 9], "model__verbose": [0, 1]}
    kept, ignored = se.different_candidates(se.Experiment("RandomForest", None, "y", "id", grid))
    assert [c["model__n_estimators"] for c in kept] == [5, 9] and ignored == ["verbose"]


def test_depth_beyond_the_limit_is_refused():
    assert mo.build_estimator("RandomForest", {}).getMaxDepth() == 30
    with pytest.raises(ValueError):
        mo.build_estimator("DecisionTree", {"max_depth": 50})
