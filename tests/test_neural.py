import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from riskloom.operators import models, neural


def made_up(n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(n) < 0.1)).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = made_up()
    return spark.createDataFrame([(f"k{i}", Vectors.dense(v.tolist()), int(t)) for i, (v, t) in enumerate(zip(x, y))], ["key", "features", "label"]).repartition(3)


@pytest.mark.parametrize("activation", sorted(neural.ACTIVATIONS))
def test_gradient_against_differences(activation):
    x, y = made_up(40)
    shape = neural.Shape((3, 4, 2, 1), activation)
    flat, w = shape.start(5), np.linspace(0.5, 2.0, 40)
    _, gradient = shape.sums(flat, x, y, w)
    for i in range(shape.size):
        step = np.zeros(shape.size)
        step[i] = 1e-6
        near = (shape.sums(flat + step, x, y, w)[0] - shape.sums(flat - step, x, y, w)[0]) / 2e-6
        assert gradient[i] == pytest.approx(near, abs=1e-4)


def test_sums_over_tasks_are_the_sums_of_all_rows(table):
    x, y = made_up()
    learner = neural.DenseLearner((4,), "tanh", alpha=2.0, early_stopping=True, share=0.3)
    rows = learner.rows(table)
    shape = neural.Shape((3, 4, 1), "tanh")
    flat = shape.start(1)
    value, gradient, held = neural.Objective(rows, shape, 2.0)(flat)
    got = {tuple(r["x"]): r["held"] for r in rows.collect()}
    out = np.array([got[tuple(v)] for v in x.tolist()], bool)
    assert 60 < out.sum() < 120
    loss, plain = shape.sums(flat, x[~out], y[~out], np.ones((~out).sum()))
    on = shape.penalised()
    assert value == pytest.approx((loss + ((flat * on) ** 2).sum()) / (~out).sum())
    assert gradient == pytest.approx((plain + 2.0 * flat * on) / (~out).sum())
    assert held == pytest.approx(shape.sums(flat, x[out], y[out], np.ones(out.sum()))[0] / out.sum())
    again = learner.rows(table.repartition(7))
    assert {tuple(r["x"]): r["held"] for r in again.collect()} == got


def test_gradient_vanishes_at_the_optimum_and_alpha_shrinks(table):
    sizes = []
    for alpha in (0.5, 5.0, 50.0):
        learner = neural.DenseLearner((3,), "tanh", alpha=alpha, max_iter=120, tol=0.0, patience=1000)
        learner.fit(table)
        shape = neural.Shape((3, 3, 1), "tanh")
        _, gradient, _ = neural.Objective(learner.rows(table), shape, alpha)(learner.fit_.flat)
        assert np.abs(gradient).max() < 1e-3
        assert learner.fit_.losses == sorted(learner.fit_.losses, reverse=True)
        sizes.append(float(((learner.fit_.flat * shape.penalised()) ** 2).sum()))
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > 2 * sizes[2]


def test_stops_on_the_held_out_loss(table):
    learner = neural.DenseLearner((30,), "relu", alpha=0.0, max_iter=150, tol=1e-4, patience=6, early_stopping=True, share=0.3)
    learner.fit(table)
    fit = learner.fit_
    assert fit.reason == "held-out loss" and len(fit.held) < 150
    assert min(fit.held) <= fit.held[-1]
    shape = neural.Shape((3, 30, 1), "relu")
    assert neural.Objective(learner.rows(table), shape, 0.0)(fit.flat)[2] == pytest.approx(min(fit.held))


def test_catalogue_fit_save_and_score(table, tmp_path):
    params = {"hidden_layer_sizes": (8, 4), "activation": "relu", "alpha": 0.01, "early_stopping": True, "n_iter_no_change": 15, "max_iter": 80, "learning_rate_init": 0.007, "tol": 1e-4}
    used, ignored = models.split_params("MLP", {**params, "learning_rate": "adaptive"})
    assert ignored == ["learning_rate"] and set(used) == set(params)
    model = models.fit_model("MLP", params, table)
    model.write().overwrite().save(f"{tmp_path}/m")
    a = sorted(models.apply_model(PipelineModel.load(f"{tmp_path}/m"), table, ["key", "label"]).collect())
    assert a == sorted(models.apply_model(model, table, ["key", "label"]).collect())
    assert sum(r["label"] == r["y_pred"] for r in a) > 230 and all(0 <= r["y_prob"] <= 1 for r in a)


def test_refusals(table):
    with pytest.raises(ValueError):
        neural.Shape((3, 1), "step")
    with pytest.raises(ValueError):
        neural.Shape((3, 0, 1))
    with pytest.raises(ValueError):
        neural.DenseLearner(share=1.0)
    with pytest.raises(ValueError):
        neural.DenseLearner().fit(table.limit(0))
