"""Batch scoring of request tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the two classes.
HIGH_RISK = "Riesgo Alto"
LOW_RISK = "Riesgo Bajo"


def risk_label(value: Column) -> Column:
    return F.when(value == 1, HIGH_RISK).otherwise(LOW_RISK)


def label_predictions(scored: DataFrame, keep: list[str], prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """Label, class and probability of the predicted class.

    Without class probabilities it is 1.0 for class 1 and 0.0 for class 0.
    """
    value = F.col(prediction).cast("int")
    if probability in scored.columns:
        kind = dict(scored.dtypes)[probability]
        array = F.col(probability) if kind.startswith("array") else vector_to_array(F.col(probability))
        prob = F.element_at(array, value + 1)
    else:
        prob = F.when(value == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    return scored.select(*keep, risk_label(value).alias("label"), value.alias("value"), prob.alias("probability"))


def score(model, requests: DataFrame, keep: list[str]) -> DataFrame:
    """Score a table of requests with a fitted pipeline; a projection per stage, no shuffle."""
    return label_predictions(model.transform(requests), keep)
