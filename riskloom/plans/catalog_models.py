"""Queries that fit, search, score and stream; fits have no SQL twin, label rules and row sets do."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import models, search
from riskloom.operators.features import build_preprocessor
from riskloom.operators.metrics import classification_metrics
from riskloom.operators.score import label_predictions
from riskloom.plans import data, jobs
from riskloom.plans.catalog_profile import rounded
from riskloom.plans.registry import query
from riskloom.runtime import materialize, scratch_path
from riskloom.sources import models as store
from riskloom.streaming.jobs import drift_stream, read_stream, score_stream

FITS = {
    "fit_logistic_l1": ("LogisticRegression", {"C": 0.1, "penalty": "l1", "class_weight": "balanced"}),
    "fit_logistic_l2": ("LogisticRegression", {"C": 1.0, "penalty": "l2"}),
    "fit_decision_tree": ("DecisionTree", {"max_depth": 5, "criterion": "entropy"}),
    "fit_random_forest": ("RandomForest", {"n_estimators": 20, "max_depth": 5, "class_weight": "balanced"}),
    "fit_boosted_trees": ("XGBoost", {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8}),
    "fit_adaboost": ("AdaBoost", {"n_estimators": 6}),
    "fit_linear_svm": ("LinearSVM", {"C": 1.0}),
    "fit_rbf_svm": ("SVC", {"C": 10.0, "kernel": "rbf", "gamma": "scale", "n_components": 100}),
    "fit_mlp": ("MLP", {"hidden_layer_sizes": [16], "max_iter": 30}),
    "fit_mlp_penalised": (
        "MLP",
        {"hidden_layer_sizes": (8, 4), "activation": "relu", "max_iter": 1500, "alpha": 5, "tol": 1e-4, "early_stopping": True, "n_iter_no_change": 15},
    ),
    "fit_knn": ("KNN", {"n_neighbors": 11, "weights": "distance", "p": 2}),
}


def experiment(model: str, grid=None, sampler=None, sampler_params=None, variant="live") -> search.Experiment:
    return search.Experiment(
        model, data.ACCOUNT_SPEC, "y", "row_id", grid or {}, sampler, sampler_params or {}, variant
    )


def _rows(spark, d, variant="extended"):
    df = data.accounts(spark, d)
    exp = experiment("lr", variant=variant)
    prep = build_preprocessor(exp.spec, variant).fit(df)
    return materialize(search.prepared(prep, df, exp), "rows")


def _fit(model, params):
    def run(spark, d):
        rows = _rows(spark, d)
        fitted = models.fit_model(model, params, rows)
        scored = materialize(models.apply_model(fitted, rows, ["key", F.col("label").alias("y_true")]), "scored")
        return classification_metrics(scored)

    return run


for _name, (_model, _params) in FITS.items():
    query(_name)(_fit(_model, _params))


@query("grid_search_results")
def grid_search_results(spark, d):
    exp = experiment("LogisticRegression", {"C": [0.05, 1.0], "penalty": ["l2"]}, variant="extended")
    return search.grid_search(data.accounts(spark, d), exp, k=3, refit=False).results.drop("params")


@query("cross_validation_table")
def cross_validation_table(spark, d):
    exp = experiment("DecisionTree", variant="extended")
    table, _ = search.evaluate(data.accounts(spark, d), exp, "tree", {"max_depth": 4}, k=2, repeats=2)
    return table


@query(
    "out_of_fold_rows",
    f"WITH a AS ({data.ACCOUNTS_SQL}) SELECT CAST(row_id AS VARCHAR) AS key, y AS y_true FROM a",
)
def out_of_fold_rows(spark, d):
    exp = experiment("DecisionTree", variant="extended")
    return search.out_of_fold(data.accounts(spark, d), exp, {"max_depth": 4}, k=3, threshold=0.4).select("key", "y_true")


@query("resampled_search")
def resampled_search(spark, d):
    exp = experiment("DecisionTree", {"max_depth": [3, 5]}, "NearMiss", {"version": 3}, "extended")
    return search.grid_search(data.accounts(spark, d), exp, k=2, refit=False).results.drop("params")


@query("train_and_record")
def train_and_record(spark, d):
    exp = experiment("LogisticRegression", variant="extended")
    run, _, matrix = search.train_and_record(data.accounts(spark, d), exp, "lr", {"C": 0.5}, k=2, repeats=1)
    scores = sorted(run["metrics"].items())
    return matrix.select("confusion_matrix", *[F.lit(v).alias(k) for k, v in scores])


@query("champion_evaluation")
def champion_evaluation(spark, d):
    from riskloom.operators.split import train_test

    train, test = train_test(data.accounts(spark, d), "y", "row_id", 0.2, 1)
    folder = scratch_path(spark, "job")
    experiments = {
        "lr": experiment("LogisticRegression", {"C": [0.1]}, variant="extended"),
        "tree": experiment("DecisionTree", {"max_depth": [4]}, variant="extended"),
    }
    jobs.train_job(train, test, experiments, f"{folder}/runs", f"{folder}/models", k=2, repeats=1)
    return jobs.evaluate_champion(test, experiments, f"{folder}/runs", f"{folder}/models", f"{folder}/report")


# ---- scoring ---------------------------------------------------------------------------------------

S = f"WITH s AS ({data.SCORED_SQL})"
LABEL = "CASE WHEN y_pred = 1 THEN 'Riesgo Alto' ELSE 'Riesgo Bajo' END"


def _with_outputs(df):
    return df.withColumn("prediction", F.col("y_pred").cast("double")).withColumn(
        "probability", F.array(1 - F.col("y_prob"), F.col("y_prob"))
    )


@query(
    "label_predictions",
    f"{S} SELECT row_id, {LABEL} AS label, y_pred AS value, round(CASE WHEN y_pred = 1 THEN y_prob ELSE 1 - y_prob END, 8) AS probability FROM s",
)
def label_predictions_query(spark, d):
    return rounded(label_predictions(_with_outputs(data.scored(spark, d)), ["row_id"]), ["probability"], 8)


@query("label_without_probability", f"{S} SELECT row_id, {LABEL} AS label, y_pred AS value, y_pred::DOUBLE AS probability FROM s")
def label_without_probability(spark, d):
    df = data.scored(spark, d).withColumn("prediction", F.col("y_pred").cast("double")).drop("y_prob")
    return label_predictions(df, ["row_id"])


@query("score_requests")
def score_requests(spark, d):
    accounts = data.accounts(spark, d)
    exp = experiment("LogisticRegression", variant="extended")
    path = scratch_path(spark, "model")
    store.save_model(search.fit_final(accounts, exp, {"C": 1.0}), path, accounts.select(*exp.spec.columns))
    return jobs.score_job(spark, path, accounts, ["row_id"])


@query(
    "model_signature",
    f"""WITH a AS ({data.ACCOUNTS_SQL}) SELECT 'amount' AS name, 'double' AS type, least(count(*), 5) AS example_rows FROM a
    UNION ALL SELECT 'term', 'double', least(count(*), 5) FROM a UNION ALL SELECT 'priority', 'string', least(count(*), 5) FROM a
    UNION ALL SELECT 'status', 'string', least(count(*), 5) FROM a UNION ALL SELECT 'grade', 'double', least(count(*), 5) FROM a""",
)
def model_signature(spark, d):
    path = scratch_path(spark, "signature")
    store.save_signature(data.accounts(spark, d).select(*data.ACCOUNT_SPEC.columns), path)
    fields, example = store.load_signature(spark, path)
    return fields.select("name", "type", F.lit(example.count()).alias("example_rows"))


@query(
    "stream_scoring",
    f"{S} SELECT row_id, {LABEL} AS label, y_pred AS value, round(CASE WHEN y_pred = 1 THEN y_prob ELSE 1 - y_prob END, 8) AS probability FROM s",
)
def stream_scoring(spark, d):
    folder = scratch_path(spark, "stream")
    data.scored(spark, d).write.parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema
    rows = read_stream(spark, f"{folder}/in", schema)
    job = score_stream(rows, lambda b: label_predictions(_with_outputs(b), ["row_id"]), f"{folder}/out", f"{folder}/check")
    job.awaitTermination()
    return rounded(spark.read.parquet(f"{folder}/out"), ["probability"], 8)


@query("stream_drift_log")
def stream_drift_log(spark, d):
    ref, cur = data.drift_sides(spark, d)
    folder = scratch_path(spark, "driftstream")
    cur.repartition(2).write.parquet(f"{folder}/in")
    rows = read_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, files_per_batch=1)
    drift_stream(rows, ref, f"{folder}/log", f"{folder}/check").awaitTermination()
    return spark.read.parquet(f"{folder}/log").drop("timestamp", "batch")


@query("drift_simulation_job")
def drift_simulation_job(spark, d):
    df = data._frame(spark, d, "events", data.DRIFT)
    record, _ = jobs.drift_job(df, "event_id", scratch_path(spark, "log"), target="late", exclude=["quarter", "parity"])
    return record.drop("timestamp")


