import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskloom.operators import clean, models


@pytest.mark.parametrize(
    "name,params",
    [
        ("LogisticRegression", {"C": 0.1, "penalty": "l1", "class_weight": "balanced"}),
        ("RandomForest", {"n_estimators": 3, "max_depth": 3}),
        ("LinearSVM", {"max_iter": 5}),
        ("SVC", {"kernel": "linear", "max_iter": 5}),
    ],
)
def test_a_session_that_observed_counts_still_scores(spark, name, params):
    """An observation leaves a part in the session that cannot be serialised; models must not take the session to the tasks."""
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(i, Vectors.dense([float(i % 7), float(i % 5)]), int(i % 7 > 3)) for i in range(60)]
    df = spark.createDataFrame(rows, ["key", "features", "label"])
    assert models.apply_model(models.fit_model(name, params, df), df, ["key"]).count() == 60
    assert len(models.apply_model(models.fit_model(name, params, df), df, ["key"]).collect()) == 60


def test_written_counts_leave_a_session_that_models_with_summaries_can_use(spark, tmp_path):
    """A session of its own: after the counts, an estimator that Spark's users fit directly still scores, summary and all."""
    spark = spark.newSession()
    rows = [(i, Vectors.dense([float(i % 7), float(i % 5)]), float(i % 7 > 3), ["0", "1.0", "x", None][i % 4]) for i in range(60)]
    df = spark.createDataFrame(rows, ["key", "features", "label", "target"])
    got = clean.write_valid(df.select("key", "target"), "target", f"{tmp_path}/valid", expected=60).first()
    assert tuple(got) == (60, 30, 30, 60, True)
    model = LogisticRegression(maxIter=3).fit(df)
    assert model.hasSummary and len(model.transform(df).select("prediction").collect()) == 60
