"""Model catalogue: estimators by name with the parameter names users already have.

Every estimator is fitted on ``features`` (vector) and ``label`` and scored as (y_pred, y_prob). Models that
Spark lacks are built from its own stages, so that a fitted model is always a ``PipelineModel`` that can be
saved, except the neighbour vote, whose model is its training table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.features import _Columns
from riskloom.operators.neighbor_index import NeighborIndex
from riskloom.operators.neural import DenseLearner
from riskloom.operators.split import with_class_weight
from riskloom.operators.trees import Draw, Rules, TreeLearner
from riskloom.runtime import materialize

DEEPEST = 30  # Spark's limit on tree depth; stands for "no limit"

# Names under which each model is known.
MODEL_NAMES = {
    "LogisticRegression": "lr",
    "lr": "lr",
    "DecisionTreeClassifier": "dt",
    "DecisionTree": "dt",
    "dt": "dt",
    "RandomForest": "rf",
    "RandomForestClassifier": "rf",
    "rf": "rf",
    "XGBoost": "xgb",
    "XGBClassifier": "xgb",
    "LightGBM": "lgbm",
    "LGBMClassifier": "lgbm",
    "GradientBoosting": "xgb",
    "xgb": "xgb",
    "AdaBoost": "ada",
    "SVC": "svc",
    "SVM": "svc",
    "svc": "svc",
    "LinearSVM": "lsvm",
    "MLP": "mlp",
    "mlp": "mlp",
    "KNeighborsClassifier": "knn",
    "KNN": "knn",
    "knn": "knn",
}

# Parameters each family understands; others are reported as ignored.
KNOWN_PARAMS = {
    "lr": {"C", "penalty", "class_weight", "max_iter", "l1_ratio"},
    "dt": {
        "criterion", "max_depth", "min_samples_leaf", "class_weight", "random_state", "max_bins", "min_samples_split",
        "ccp_alpha", "max_leaf_nodes", "max_features",
    },
    "rf": {
        "n_estimators", "criterion", "max_depth", "min_samples_leaf", "max_features", "class_weight",
        "random_state", "max_bins", "bootstrap", "min_samples_split", "ccp_alpha", "max_leaf_nodes",
    },
    "xgb": {
        "n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "scale_pos_weight",
        "random_state", "max_bins", "reg_lambda", "reg_alpha", "gamma", "min_child_weight",
    },
    "lgbm": {
        "n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "scale_pos_weight", "class_weight",
        "random_state", "max_bins", "reg_lambda", "reg_alpha", "num_leaves", "min_child_samples", "min_child_weight", "min_split_gain",
    },
    "ada": {"n_estimators", "learning_rate", "random_state"},
    "svc": {"kernel", "C", "gamma", "class_weight", "random_state", "max_iter", "n_components", "probability"},
    "lsvm": {"C", "class_weight", "max_iter"},
    "mlp": {
        "hidden_layer_sizes", "max_iter", "random_state", "learning_rate_init", "alpha", "activation", "early_stopping", "tol",
        "n_iter_no_change", "validation_fraction",
    },
    "knn": {"n_neighbors", "weights", "p"},
}


# Parameters that only trees of our own growing have; a candidate that names one gets such trees, whatever its value.
GROWN_PARAMS = {
    "dt": {"min_samples_split", "ccp_alpha", "max_leaf_nodes", "max_features"},
    "rf": {"min_samples_split", "ccp_alpha", "max_leaf_nodes"},
    "xgb": {"reg_lambda", "reg_alpha", "gamma", "min_child_weight"},
}
# The same for networks: these ask for penalised quasi-Newton steps; ``learning_rate_init`` has no part in them.
DENSE_PARAMS = {"alpha", "activation", "early_stopping", "tol", "n_iter_no_change", "validation_fraction"}


def family(name: str) -> str:
    """Family key of a model name; an unknown name is an error."""
    if name not in MODEL_NAMES:
        raise KeyError(f"unknown model {name!r}; known: {sorted(MODEL_NAMES)}")
    return MODEL_NAMES[name]


def split_params(name: str, params: Mapping) -> tuple[dict, list[str]]:
    """(parameters the family understands, names of the ignored ones); pipeline prefixes are cut."""
    known = KNOWN_PARAMS[family(name)]
    bare = {k.removeprefix("model__").removeprefix("classifier__"): v for k, v in params.items()}
    return {k: v for k, v in bare.items() if k in known}, sorted(k for k in bare if k not in known)


def _depth(p: Mapping, default) -> int:
    depth = p.get("max_depth", default)
    if depth is not None and int(depth) > DEEPEST:
        raise ValueError(f"max_depth {depth} is beyond the limit of {DEEPEST}")
    return DEEPEST if depth is None else int(depth)


def _impurity(p: Mapping) -> str:
    return "gini" if p.get("criterion", "gini") == "gini" else "entropy"


def _grown(fam: str, p: Mapping, seed: int) -> TreeLearner:
    """Trees grown from histograms, with the defaults of the libraries the parameter names come from."""
    depth = p.get("max_depth")
    bins = int(p.get("max_bins", 32))
    if fam in ("dt", "rf"):
        rules = Rules(
            "gini" if p.get("criterion", "gini") == "gini" else "entropy", None if depth is None else int(depth), int(p.get("min_samples_split", 2)),
            int(p.get("min_samples_leaf", 1)), p.get("max_leaf_nodes"), p.get("max_features", "sqrt" if fam == "rf" else None),
        )
        draw = Draw(bootstrap=fam == "rf" and bool(p.get("bootstrap", True)), seed=seed)
        return TreeLearner(rules, int(p.get("n_estimators", 100)) if fam == "rf" else 1, bins, draw, ccp_alpha=float(p.get("ccp_alpha", 0.0)))
    penalty = {"reg_lambda": float(p.get("reg_lambda", 1.0 if fam == "xgb" else 0.0)), "reg_alpha": float(p.get("reg_alpha", 0.0))}
    if fam == "xgb":
        rules = Rules("second_order", 6 if depth is None else int(depth), min_child_weight=float(p.get("min_child_weight", 1.0)), gamma=float(p.get("gamma", 0.0)), **penalty)
    else:
        rules = Rules(
            "second_order", None if depth is None or int(depth) < 1 else int(depth), min_samples_leaf=int(p.get("min_child_samples", 20)), max_leaves=int(p.get("num_leaves", 31)),
            min_child_weight=float(p.get("min_child_weight", 1e-3)), gamma=float(p.get("min_split_gain", 0.0)), **penalty,
        )
    draw = Draw(float(p.get("subsample", 1.0)), seed=seed)
    return TreeLearner(rules, int(p.get("n_estimators", 100)), bins, draw, True, float(p.get("learning_rate", 0.3 if fam == "xgb" else 0.1)), float(p.get("colsample_bytree", 1.0)))


def build_estimator(name: str, params: Mapping | None = None, rows: float = 1.0, width: int = 1, seed: int = 1) -> Estimator:
    """A ``pyspark.ml`` estimator for a model name and its parameters.

    ``rows`` (sum of weights) turns an inverse penalty C into Spark's mean-loss penalty 1 / (C * rows).
    """
    fam = family(name)
    p, _ = split_params(name, params or {})
    seed = int(p.get("random_state") or seed)
    weighted = {"weightCol": "weight"} if p.get("class_weight") or p.get("scale_pos_weight") else {}
    base = {"featuresCol": "features", "labelCol": "label"}
    if fam == "lgbm" or GROWN_PARAMS.get(fam, set()) & set(p):
        return _grown(fam, p, seed)
    if fam == "lr":
        mix = {"l1": 1.0, "l2": 0.0, "elasticnet": p.get("l1_ratio") or 0.5}.get(p.get("penalty", "l2"), 0.0)
        strength = 0.0 if p.get("penalty", "l2") in (None, "none") else 1.0 / (float(p.get("C", 1.0)) * rows)
        return LogisticRegression(
            regParam=strength, elasticNetParam=float(mix), standardization=False, maxIter=int(p.get("max_iter", 100)), **base, **weighted
        )
    if fam == "dt":
        return DecisionTreeClassifier(
            impurity=_impurity(p), maxDepth=_depth(p, None), seed=seed,
            minInstancesPerNode=int(p.get("min_samples_leaf", 1)), maxBins=int(p.get("max_bins", 32)), **base, **weighted,
        )
    if fam == "rf":
        subset = p.get("max_features", "sqrt")
        return RandomForestClassifier(
            numTrees=int(p.get("n_estimators", 100)), impurity=_impurity(p), maxDepth=_depth(p, None),
            minInstancesPerNode=int(p.get("min_samples_leaf", 1)), featureSubsetStrategy="all" if subset is None else str(subset),
            bootstrap=bool(p.get("bootstrap", True)), maxBins=int(p.get("max_bins", 32)), seed=seed, **base, **weighted,
        )
    if fam == "xgb":
        return GBTClassifier(
            maxIter=int(p.get("n_estimators", 100)), maxDepth=_depth(p, 3), stepSize=float(p.get("learning_rate", 0.1)),
            subsamplingRate=float(p.get("subsample", 1.0)), featureSubsetStrategy=_share(p.get("colsample_bytree", 1.0)),
            maxBins=int(p.get("max_bins", 32)), seed=seed, **base, **weighted,
        )
    if fam == "ada":
        return AdaBoost(rounds=int(p.get("n_estimators", 50)), rate=float(p.get("learning_rate", 1.0)), seed=seed)
    if fam == "lsvm":
        return LinearSVC(regParam=1.0 / (float(p.get("C", 1.0)) * rows), maxIter=int(p.get("max_iter", 100)), **base, **weighted)
    if fam == "svc":
        return KernelSvc(
            kernel=p.get("kernel", "rbf"), penalty=1.0 / (float(p.get("C", 1.0)) * rows), gamma=p.get("gamma", "scale"),
            components=int(p.get("n_components", 200)), seed=seed, weighted=bool(weighted), max_iter=int(p.get("max_iter", 100)),
        )
    if fam == "mlp":
        hidden = p.get("hidden_layer_sizes", (100,))
        hidden = [hidden] if isinstance(hidden, int) else list(hidden)
        if DENSE_PARAMS & set(p):
            return DenseLearner(
                hidden, p.get("activation", "relu"), float(p.get("alpha", 1e-4)), int(p.get("max_iter", 200)), float(p.get("tol", 1e-4)),
                int(p.get("n_iter_no_change", 10)), bool(p.get("early_stopping", False)), float(p.get("validation_fraction", 0.1)), seed,
            )
        return MultilayerPerceptronClassifier(
            layers=[width, *[int(h) for h in hidden], 2], maxIter=int(p.get("max_iter", 200)), seed=seed,
            stepSize=float(p.get("learning_rate_init", 0.03)), **base,
        )
    return NeighborVote(k=int(p.get("n_neighbors", 5)), weights=p.get("weights", "uniform"), p=int(p.get("p", 2)))


def _share(value) -> str:
    """Feature-subset text for a share of columns; the whole is spelled ``all``."""
    return "all" if float(value) >= 1.0 else str(float(value))


def with_weights(df: DataFrame, params: Mapping) -> DataFrame:
    """Row weights asked for by ``class_weight='balanced'``, a class mapping or ``scale_pos_weight``."""
    bare = {k.split("__")[-1]: v for k, v in params.items()}
    if bare.get("scale_pos_weight"):
        return with_class_weight(df, "label", "weight", {0: 1.0, 1: float(bare["scale_pos_weight"])})
    if bare.get("class_weight") == "balanced":
        return with_class_weight(df, "label", "weight")
    if isinstance(bare.get("class_weight"), Mapping):
        return with_class_weight(df, "label", "weight", dict(bare["class_weight"]))
    return df


def without_summary(model):
    """The model without its training summary: a summary refers to the Spark session, and both would go to every task that scores.

    Parts of a session that are made on demand cannot be serialised, so in a long session scoring failed.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def fit_model(name: str, params: Mapping | None, train: DataFrame, seed: int = 1):
    """Fit a catalogue model on (key, features, label); weights and sizes are taken from the data."""
    params = dict(params or {})
    rows = train.count() if family(name) in ("lr", "svc", "lsvm") else 1
    width = 1
    if family(name) == "mlp":
        width = train.select(F.size(vector_to_array("features"))).first()[0]
    data = with_weights(train.withColumn("label", F.col("label").cast("double")), params)
    return without_summary(build_estimator(name, params, rows, width, seed).fit(data))


def apply_model(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., y_pred, y_prob); y_prob is the probability of class 1, or the margin where there is none."""
    out = model.transform(df)
    if "y_prob" in out.columns:
        return out.select(*keep, "y_pred", "y_prob")
    column = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(*keep, F.col("prediction").cast("int").alias("y_pred"), vector_to_array(column)[1].alias("y_prob"))


# ---- boosted stumps --------------------------------------------------------------------------------


class VoteSum(_Columns, Transformer):
    """Weighted vote of earlier tree predictions into probability and prediction."""

    def _transform(self, df: DataFrame) -> DataFrame:
        share = vote_share(self.getInputCols(), self.fitted())
        prob = 1.0 / (1.0 + F.exp(-share))
        out = df.withColumn("_p1", prob).withColumn("prediction", (F.col("_p1") > 0.5).cast("double"))
        out = out.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p1"), F.col("_p1"))))
        extra = [c for c in out.columns if c.startswith(("_vote_", "_voteraw_", "_voteprob_"))]
        return out.drop("_p1", *extra)


def vote_share(columns: list[str], alphas: list[float]) -> Column:
    """Mean of +1/-1 votes weighted by alpha, in [-1, 1]."""
    total = sum(alphas) or 1.0
    score = F.lit(0.0)
    for c, a in zip(columns, alphas):
        score = score + F.when(F.col(c) == 1, F.lit(a / total)).otherwise(F.lit(-a / total))
    return score


class AdaBoost(Estimator):
    """Boosted decision stumps (discrete AdaBoost, Freund and Schapire 1997) over Spark's weighted trees.

    One pass per round fits a tree and one aggregates its weighted error. Row weights are stored every few
    rounds, so a plan never carries more than a handful of trees.
    """

    STORE_EVERY = 5

    def __init__(self, rounds: int = 50, rate: float = 1.0, seed: int = 1, depth: int = 1):
        super().__init__()
        self.rounds, self.rate, self.seed, self.depth = rounds, rate, seed, depth

    def _fit(self, df: DataFrame) -> PipelineModel:
        data = df.select("features", "label").withColumn("weight", F.lit(1.0))
        n = data.count()
        data = data.withColumn("weight", F.lit(1.0 / n))
        trees, alphas, names = [], [], []
        for r in range(self.rounds):
            tree = DecisionTreeClassifier(
                featuresCol="features", labelCol="label", weightCol="weight", maxDepth=self.depth, seed=self.seed + r,
                predictionCol=f"_vote_{r}", rawPredictionCol=f"_voteraw_{r}", probabilityCol=f"_voteprob_{r}",
            ).fit(data)
            judged = tree.transform(data)
            wrong = F.col(f"_vote_{r}") != F.col("label")
            row = judged.agg(F.sum(F.when(wrong, F.col("weight")).otherwise(0.0)).alias("e"), F.sum("weight").alias("w")).first()
            error = row["e"] / row["w"]
            if error >= 0.5:
                if not trees:
                    trees, alphas, names = [tree], [1.0], [f"_vote_{r}"]
                break
            alpha = self.rate * (math.log((1 - error) / error) if error > 0 else 1.0)
            trees.append(tree)
            alphas.append(alpha)
            names.append(f"_vote_{r}")
            if error <= 0:
                break
            grown = F.col("weight") * F.when(wrong, F.lit(math.exp(alpha))).otherwise(F.lit(1.0)) / F.lit(row["w"])
            data = judged.select("features", "label", grown.alias("weight"))
            if (r + 1) % self.STORE_EVERY == 0:
                data = materialize(data, "boost")
        vote = VoteSum(inputCols=names, outputCols=["prediction"], state=json.dumps(alphas))
        return PipelineModel(stages=[*trees, vote])


# ---- kernel machine --------------------------------------------------------------------------------


class FourierFeatures(_Columns, Transformer):
    """Random cosine features that approximate the RBF kernel (Rahimi and Recht, 2007).

    The projection is rebuilt from its seed inside each task; one matrix product per Arrow batch.
    """

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted()
        source, target = self.getInputCols()[0], self.getOutputCols()[0]

        @F.arrow_udf("array<double>")
        def project(v: pa.Array) -> pa.Array:
            rng = np.random.RandomState(s["seed"])
            w = rng.normal(scale=math.sqrt(2 * s["gamma"]), size=(s["width"], s["components"]))
            b = rng.uniform(0, 2 * math.pi, size=s["components"])
            # As two flat lists of numbers, without an object per row.
            out = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), s["width"]) @ w
            out += b
            np.cos(out, out=out)
            out *= math.sqrt(2.0 / s["components"])
            return pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype="int32") * s["components"], out.ravel())

        return df.withColumn(target, array_to_vector(project(vector_to_array(source))))


class MarginVector(_Columns, Transformer):
    """The margin of a linear machine as a one-element vector, and removal of its other outputs."""

    def _transform(self, df: DataFrame) -> DataFrame:
        margin = vector_to_array("_svcraw")[1]
        return df.withColumn("_margin", array_to_vector(F.array(margin))).drop("_svcraw", "_svcpred")


class CalibratedOutput(_Columns, Transformer):
    """Removal of the intermediate columns of a calibrated machine."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop("_fourier", "_margin")


class KernelSvc(Estimator):
    """Support vector machine with class probabilities: RBF features (or none) + linear machine + Platt scaling."""

    def __init__(self, kernel="rbf", penalty=0.01, gamma="scale", components=200, seed=1, weighted=False, max_iter=100):
        super().__init__()
        self.kernel, self.penalty, self.gamma = kernel, penalty, gamma
        self.components, self.seed, self.weighted, self.max_iter = components, seed, weighted, max_iter

    def _gamma(self, df: DataFrame, width: int) -> float:
        if self.gamma == "auto":
            return 1.0 / width
        if self.gamma == "scale":
            entries = df.select(F.explode(vector_to_array("features")).alias("x"))
            spread = entries.agg(F.var_pop("x")).first()[0]
            return 1.0 / (width * spread) if spread else 1.0
        return float(self.gamma)

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages: list = []
        column = "features"
        if self.kernel == "rbf":
            width = df.select(F.size(vector_to_array("features"))).first()[0]
            state = {"seed": self.seed, "gamma": self._gamma(df, width), "width": width, "components": self.components}
            stages.append(FourierFeatures(inputCols=["features"], outputCols=["_fourier"], state=json.dumps(state)))
            column = "_fourier"
        elif self.kernel != "linear":
            raise ValueError(f"kernel must be rbf or linear, not {self.kernel}")
        data = stages[0].transform(df) if stages else df
        extra = {"weightCol": "weight"} if self.weighted else {}
        machine = LinearSVC(
            featuresCol=column, labelCol="label", regParam=self.penalty, maxIter=self.max_iter,
            rawPredictionCol="_svcraw", predictionCol="_svcpred", **extra,
        ).fit(data)
        machine = without_summary(machine)
        to_margin = MarginVector(inputCols=["_svcraw"], outputCols=["_margin"])
        # Stored, because scaling reads the margins several times, and each would project every row again.
        margins = materialize(to_margin.transform(machine.transform(data)).select("_margin", "label"), "margins")
        platt = without_summary(LogisticRegression(featuresCol="_margin", labelCol="label").fit(margins))
        tidy = CalibratedOutput(inputCols=["_margin"], outputCols=["_margin"])
        return PipelineModel(stages=[*stages, machine, to_margin, platt, tidy])


# ---- neighbours ------------------------------------------------------------------------------------


class NeighborVote(Estimator):
    """k-nearest-neighbour vote; fitting writes an index of the training table."""

    def __init__(self, k: int = 5, weights: str = "uniform", p: int = 2):
        super().__init__()
        self.k, self.weights, self.p = k, weights, p

    def _fit(self, df: DataFrame) -> "NeighborVoteModel":
        rows = df.select(F.col("key").cast("string").alias("id"), vector_to_array("features").alias("vec"), F.col("label").cast("int").alias("y"))
        return NeighborVoteModel(NeighborIndex.build(rows, 1 if self.p == 1 else 2), self.k, self.weights)


class NeighborVoteModel(Model):
    """Exact vote of the k nearest indexed rows; needs a unique ``key`` column in the scored table."""

    def __init__(self, index: NeighborIndex, k: int, weights: str):
        super().__init__()
        self.index, self.k, self.weights = index, k, weights

    def _transform(self, df: DataFrame) -> DataFrame:
        asked = df.select(F.col("key").cast("string").alias("id"), vector_to_array("features").alias("vec"))
        votes = self.index.vote(asked, self.k, self.weights).withColumnRenamed("id", "_id")
        return df.join(votes, F.col("key").cast("string") == F.col("_id")).drop("_id")

    def save_to(self, path: str) -> None:
        settings = self.index.spark.createDataFrame([(self.k, self.weights)], "k int, weights string")
        self.index.save(path)
        settings.coalesce(1).write.mode("overwrite").json(f"{path}/settings")

    @classmethod
    def load_from(cls, spark, path: str) -> "NeighborVoteModel":
        s = spark.read.json(f"{path}/settings").first()
        return cls(NeighborIndex(spark, path), s["k"], s["weights"])
