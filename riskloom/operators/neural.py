"""A dense network with L2 penalty, choice of activation and early stopping, fitted by full-batch quasi-Newton steps.

Every step is one pass over stored rows: tasks run forward and backward over Arrow batches and hand on one sum per weight, which Spark adds up
before a few thousand numbers reach the driver. The limited-memory BFGS direction (Nocedal, 1980) is worked out there. A held-out
share is chosen by digests of the row keys and judged in the same pass, so stopping costs no further job and does not depend on partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import draw_hash, uniform
from riskloom.operators.features import _Columns
from riskloom.runtime import materialize

ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "logistic": (lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))), lambda a: a * (1.0 - a)),
    "identity": (lambda z: z, np.ones_like),
}
HISTORY = 10  # pairs of steps the direction remembers
TRIES = 12  # halvings of a step before the search gives up


@dataclass(frozen=True)
class Shape:
    """Layer widths from the features to the one output, and the activation of the hidden ones."""

    widths: tuple[int, ...]
    activation: str = "relu"

    def __post_init__(self):
        if self.activation not in ACTIVATIONS:
            raise ValueError(f"unknown activation {self.activation}; known: {sorted(ACTIVATIONS)}")
        if any(w < 1 for w in self.widths):
            raise ValueError("every layer needs at least one unit")

    @property
    def size(self) -> int:
        return sum((a + 1) * b for a, b in zip(self.widths, self.widths[1:]))

    def layers(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(weights, biases) per layer, as views of one vector."""
        out, at = [], 0
        for a, b in zip(self.widths, self.widths[1:]):
            out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + (a + 1) * b]))
            at += (a + 1) * b
        return out

    def penalised(self) -> np.ndarray:
        """1 for weights, 0 for biases."""
        flat = np.zeros(self.size)
        for w, _ in self.layers(flat):
            w[:] = 1.0
        return flat

    def start(self, seed: int) -> np.ndarray:
        """Uniform weights scaled to the widths on both sides (Glorot and Bengio, 2010)."""
        rng = np.random.default_rng(seed)
        flat = np.zeros(self.size)
        for w, b in self.layers(flat):
            bound = np.sqrt((2.0 if self.activation == "logistic" else 6.0) / sum(w.shape))
            w[:], b[:] = rng.uniform(-bound, bound, w.shape), rng.uniform(-bound, bound, b.shape)
        return flat

    def forward(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Activations of every layer; the last is the logit."""
        out, act = [x], ACTIVATIONS[self.activation][0]
        layers = self.layers(flat)
        for k, (w, b) in enumerate(layers):
            z = out[-1] @ w + b
            out.append(z if k == len(layers) - 1 else act(z))
        return out

    def sums(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted sum of the log losses and its gradient, without penalty."""
        acts = self.forward(flat, x)
        logit = acts[-1][:, 0]
        total = float((weight * (np.logaddexp(0.0, logit) - y * logit)).sum())
        gradient = np.zeros(self.size)
        into = self.layers(gradient)
        layers = self.layers(flat)
        delta = (weight * (1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500))) - y))[:, None]
        for k in reversed(range(len(layers))):
            into[k][0][:], into[k][1][:] = acts[k].T @ delta, delta.sum(0)
            if k:
                delta = (delta @ layers[k][0].T) * ACTIVATIONS[self.activation][1](acts[k])
        return total, gradient


def _pass(batches: Iterator[pa.RecordBatch], shape: Shape, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of this task as (place, value): gradient entries, then training loss and weight, held-out loss and weight."""
    total = np.zeros(shape.size + 4)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        y, w, held = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "held")]
        held = held.astype(bool)
        loss, gradient = shape.sums(flat, x[~held], y[~held], w[~held])
        total[: shape.size] += gradient
        total[shape.size :] += [loss, w[~held].sum(), shape.sums(flat, x[held], y[held], w[held])[0] if held.any() else 0.0, w[held].sum()]
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])


class Objective:
    """Penalised mean loss and gradient over stored rows; counts its passes."""

    def __init__(self, rows: DataFrame, shape: Shape, alpha: float):
        self.rows, self.shape, self.alpha, self.passes = rows, shape, alpha, 0

    def __call__(self, flat: np.ndarray) -> tuple[float, np.ndarray, float | None]:
        """(training loss, gradient, held-out loss or None)."""
        self.passes += 1
        shape, sc = self.shape, self.rows.sparkSession.sparkContext
        shared = sc.broadcast(flat)

        def run(batches):
            yield from _pass(batches, shape, shared.value)

        sums = self.rows.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(shape.size + 4)
        for r in sums:
            out[r["place"]] = r["value"]
        loss, weight, held, held_weight = out[shape.size :]
        if not weight:
            raise ValueError("no rows to fit on")
        on = shape.penalised()
        value = (loss + 0.5 * self.alpha * float(((flat * on) ** 2).sum())) / weight
        return value, (out[: shape.size] + self.alpha * flat * on) / weight, held / held_weight if held_weight else None


@dataclass
class Fit:
    """The weights kept, how the fit went, and why it ended."""

    flat: np.ndarray
    losses: list[float]
    held: list[float]
    reason: str


def minimise(objective: Objective, start: np.ndarray, max_iter: int, tol: float, patience: int, early: bool) -> Fit:
    """Quasi-Newton steps until the gradient vanishes, the loss stands still or, with ``early``, the held-out loss has not fallen for ``patience`` steps.

    With ``early`` the weights of the least held-out loss are kept.
    """
    flat = start
    value, gradient, held = objective(flat)
    losses, helds = [value], [] if held is None else [held]
    best, kept, still = (held if held is not None else value), flat, 0
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    reason = "max_iter"
    for _ in range(max_iter):
        if np.abs(gradient).max() < 1e-6:
            reason = "gradient"
            break
        direction = _direction(gradient, pairs)
        slope = float(direction @ gradient)
        if slope >= 0:
            pairs, direction, slope = [], -gradient, -float(gradient @ gradient)
        step = 1.0 if pairs else min(1.0, 1.0 / float(np.abs(gradient).sum()))
        for _ in range(TRIES):
            tried = flat + step * direction
            new = objective(tried)
            if new[0] <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            if not pairs:
                reason = "no descent"
                break
            pairs = []
            continue
        change = (tried - flat, new[1] - gradient)
        if float(change[0] @ change[1]) > 1e-12:
            pairs = [*pairs, change][-HISTORY:]
        flat, (value, gradient, held) = tried, new
        losses.append(value)
        if held is not None:
            helds.append(held)
        score = held if early and held is not None else value
        if score < best - tol:
            still = 0
        else:
            still += 1
        if score < best:
            best, kept = score, flat
        if still >= patience:
            reason = "held-out loss" if early and held is not None else "loss"
            break
    return Fit(kept if early else flat, losses, helds, reason)


def _direction(gradient: np.ndarray, pairs) -> np.ndarray:
    q = gradient.copy()
    used = []
    for s, y in reversed(pairs):
        a = float(s @ q) / float(s @ y)
        q -= a * y
        used.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= float(s @ y) / float(y @ y)
    for (s, y), a in zip(pairs, reversed(used)):
        q += s * (a - float(y @ q) / float(s @ y))
    return -q


class DenseNet(_Columns, Model):
    """A fitted network as a stage: probability and prediction from ``features``."""

    def shape(self) -> Shape:
        s = self.fitted()
        return Shape(tuple(s["widths"]), s["activation"])

    def _transform(self, df: DataFrame) -> DataFrame:
        shape, flat = self.shape(), np.array(self.fitted()["flat"])

        @F.pandas_udf("double")
        def score(v: pd.Series) -> pd.Series:
            if not len(v):
                return pd.Series([], dtype="float64")
            return pd.Series(1.0 / (1.0 + np.exp(-np.clip(shape.forward(flat, np.stack(v.to_numpy()))[-1][:, 0], -500, 500))))

        out = df.withColumn("_p1", score(vector_to_array(self.getInputCols()[0]))).withColumn("prediction", (F.col("_p1") > 0.5).cast("double"))
        return out.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p1"), F.col("_p1")))).drop("_p1")


class DenseLearner(Estimator):
    """Fits (features, label[, weight][, key]); ``alpha`` is divided by the weight of the rows, biases are free of it."""

    def __init__(
        self, hidden: Sequence[int] = (100,), activation: str = "relu", alpha: float = 1e-4, max_iter: int = 200, tol: float = 1e-4, patience: int = 10,
        early_stopping: bool = False, share: float = 0.1, seed: int = 1,
    ):
        super().__init__()
        if not 0 < share < 1:
            raise ValueError("the held-out share must lie between 0 and 1")
        self.hidden, self.activation, self.alpha, self.max_iter = tuple(int(h) for h in hidden), activation, alpha, max_iter
        self.tol, self.patience, self.early, self.share, self.seed = tol, patience, early_stopping, share, seed
        self.fit_: Fit | None = None

    def rows(self, df: DataFrame) -> DataFrame:
        """Stored rows (x, y, w, held); the held-out share depends on the key, or on the row where there is none."""
        key = F.col("key").cast("string") if "key" in df.columns else F.concat_ws(",", vector_to_array("features").cast("array<string>"))
        held = uniform(draw_hash(f"held:{self.seed}", key)) < self.share if self.early else F.lit(False)
        weight = F.col("weight").cast("double") if "weight" in df.columns else F.lit(1.0)
        return materialize(df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), weight.alias("w"), held.cast("int").alias("held")), "net")

    def _fit(self, df: DataFrame) -> PipelineModel:
        first = df.select(F.size(vector_to_array("features"))).first()
        if first is None:
            raise ValueError("no rows to fit on")
        shape = Shape((first[0], *self.hidden, 1), self.activation)
        self.fit_ = minimise(Objective(self.rows(df), shape, self.alpha), shape.start(self.seed), self.max_iter, self.tol, self.patience, self.early)
        state = {"widths": shape.widths, "activation": shape.activation, "flat": self.fit_.flat.tolist()}
        return PipelineModel(stages=[DenseNet(inputCols=["features"], outputCols=["probability"], state=json.dumps(state))])
