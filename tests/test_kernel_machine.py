"""The kernel machine projects rows in columns, and its scaling reads stored margins."""

import json
import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import models


def _rows(spark, n=400):
    rng = np.random.RandomState(4)
    x = rng.normal(size=(n, 3))
    y = ((x * x).sum(1) < 2).astype(float)
    df = spark.createDataFrame([(i, x[i].tolist(), float(y[i])) for i in range(n)], "key int, v array<double>, label double")
    return x, df.select("key", "label", array_to_vector("v").alias("features"))


def test_projection_equals_its_formula(spark):
    x, df = _rows(spark)
    state = {"seed": 7, "gamma": 0.3, "width": 3, "components": 12}
    stage = models.FourierFeatures(inputCols=["features"], outputCols=["f"], state=json.dumps(state))
    out = stage.transform(df.repartition(5)).select("key", vector_to_array("f").alias("f")).collect()
    rng = np.random.RandomState(7)
    w, b = rng.normal(scale=math.sqrt(0.6), size=(3, 12)), rng.uniform(0, 2 * math.pi, size=12)
    wanted = np.cos(x @ w + b) * math.sqrt(2 / 12)
    assert len(out) == len(x)
    assert np.allclose([r["f"] for r in sorted(out, key=lambda r: r["key"])], wanted, atol=1e-12)
    assert stage.transform(df.where("key < 0")).count() == 0


def test_scaling_does_not_project_again(spark, monkeypatch):
    _, df = _rows(spark)
    seen = []

    class Watched(models.LogisticRegression):
        def fit(self, rows, *rest):
            seen.append((rows.columns, rows._jdf.queryExecution().optimizedPlan().toString()))
            return super().fit(rows, *rest)

    monkeypatch.setattr(models, "LogisticRegression", Watched)
    model = models.fit_model("SVC", {"n_components": 30, "max_iter": 10}, df)
    [(columns, plan)] = seen
    assert columns == ["_margin", "label"]
    assert "python" not in plan.lower()  # the projection is a Python function
    right = models.apply_model(model, df, ["label"]).where(F.col("y_pred") == F.col("label")).count()
    assert right > 320
