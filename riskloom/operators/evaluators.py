"""The exact metrics as ``pyspark.ml`` evaluators, for Spark's own tuning classes."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.metrics import METRICS, classification_metrics


class ScoreEvaluator(Evaluator, HasLabelCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """One of accuracy, precision, recall, f1, gmean or roc_auc of a scored table; all of them are better when larger.

    The area is exact: equal scores count half, and scores are not binned. An undefined value (one class only) counts as 0, so
    that a split without it never wins.
    """

    metricName = Param(Params._dummy(), "metricName", f"one of {', '.join(METRICS)}", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, metricName="roc_auc", labelCol="label", predictionCol="prediction", probabilityCol="probability"):
        super().__init__()
        self._setDefault(metricName="roc_auc", labelCol="label", predictionCol="prediction", probabilityCol="probability")
        self._set(**self._input_kwargs)
        if self.getOrDefault(self.metricName) not in METRICS:
            raise ValueError(f"unknown metric {metricName}; known: {sorted(METRICS)}")

    def _evaluate(self, dataset: DataFrame) -> float:
        name = self.getOrDefault(self.metricName)
        columns = [F.col(self.getLabelCol()).cast("int").alias("y_true"), F.col(self.getPredictionCol()).cast("int").alias("y_pred")]
        score = None
        if name == "roc_auc":
            if self.getProbabilityCol() not in dataset.columns:
                raise ValueError(f"roc_auc needs a column {self.getProbabilityCol()}")
            score = "y_prob"
            columns.append(vector_to_array(self.getProbabilityCol())[1].alias(score))
        value = classification_metrics(dataset.select(*columns), score=score).first()[name]
        return 0.0 if value is None else float(value)

    def isLargerBetter(self) -> bool:
        return True
