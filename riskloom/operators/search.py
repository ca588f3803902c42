"""Cross-validation and grid search with resampling inside the training fold only."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import FeatureSpec
from riskloom.operators.features import build_preprocessor
from riskloom.operators.metrics import METRICS, classification_metrics, confusion_matrix, cv_summary, metrics_long
from riskloom.operators.models import apply_model, family, fit_model, split_params
from riskloom.operators.sampling import no_sampling, sampler_by_name
from riskloom.operators.select import best_passing, with_gates
from riskloom.operators.split import stratified_folds
from riskloom.runtime import materialize, scratch_path
from riskloom.sources.models import FittedPipeline
from riskloom.sources.runs import new_run


@dataclass
class Experiment:
    """What to train: model name, parameter grid, sampler and its parameters, feature roles and variant."""

    model: str
    spec: FeatureSpec
    label: str
    key: str
    param_grid: Mapping[str, Sequence] = field(default_factory=dict)
    sampler: str | None = None
    sampler_params: Mapping = field(default_factory=dict)
    variant: str = "live"
    seed: int = 1

    def candidates(self) -> list[dict]:
        names = sorted(self.param_grid)
        return [dict(zip(names, values)) for values in itertools.product(*[self.param_grid[n] for n in names])]


def prepared(fitted_prep, df: DataFrame, exp: Experiment) -> DataFrame:
    """(key, label, features) of a table after preprocessing."""
    return fitted_prep.transform(df).select(
        F.col(exp.key).cast("string").alias("key"), F.col(exp.label).cast("int").alias("label"), "features"
    )


def resample(df: DataFrame, exp: Experiment) -> DataFrame:
    """Apply the experiment's sampler to prepared rows."""
    sampler = sampler_by_name(exp.sampler)
    if sampler is no_sampling:
        return df
    arrays = df.withColumn("features", vector_to_array("features"))
    params = dict(exp.sampler_params)
    seed = exp.seed
    if params.get("random_state") is not None:
        seed = int(params["random_state"])
    params.pop("random_state", None)
    if "n_neighbors" in params:
        params["k"] = params.pop("n_neighbors")
    if "k_neighbors" in params:
        params["k"] = params.pop("k_neighbors")
    if "sampling_strategy" in params:
        params["ratio"] = params.pop("sampling_strategy")
    picked = sampler(arrays, "label", "key", "features", seed=seed, **params)
    return picked.withColumn("features", array_to_vector("features"))


def fit_final(df: DataFrame, exp: Experiment, params: Mapping | None = None) -> FittedPipeline:
    """Fit preprocessing, sampler and model on all rows of ``df``."""
    prep = build_preprocessor(exp.spec, exp.variant).fit(df)
    rows = materialize(resample(prepared(prep, df, exp), exp), "final")
    return FittedPipeline(prep, fit_model(exp.model, params or {}, rows, exp.seed))


def score_labelled(fitted: FittedPipeline, df: DataFrame, exp: Experiment) -> DataFrame:
    """(key, y_true, y_pred, y_prob) of a labelled table."""
    rows = prepared(fitted.prep, df, exp)
    return apply_model(fitted.model, rows, ["key", F.col("label").alias("y_true")])


def cross_validate(
    df: DataFrame,
    exp: Experiment,
    candidates: Sequence[Mapping],
    k: int = 5,
    repeats: int = 1,
    parallelism: int = 4,
    with_train: bool = True,
    fold_seed: int | None = None,
    failures: dict[int, str] | None = None,
) -> DataFrame:
    """Scored rows of every candidate, repeat, fold and side, as one stored table.

    Preprocessing and resampling are fitted once per fold and shared by all candidates; folds run side by
    side on the driver's threads. Each scored fold is one folder of the table, so nothing is held on the
    driver and a failed candidate leaves the others untouched. A candidate that fails in any fold is left out whole;
    it is an error if none is complete, so a single candidate is either scored on every row or raises.
    ``failures``, if given, receives the error of each candidate left out.
    """
    family(exp.model), sampler_by_name(exp.sampler)  # unknown names fail here, before any work
    spark = df.sparkSession
    base = scratch_path(spark, "folds")
    df = df.select(exp.key, *exp.spec.columns, exp.label)
    keep = ["key", F.col("label").alias("y_true")]
    seed = exp.seed if fold_seed is None else fold_seed
    failures = {} if failures is None else failures
    folded = {}
    for r in range(repeats):
        # stored once, because every fold's fits read it several times
        folded[r] = materialize(stratified_folds(df, exp.label, exp.key, k, seed + r, "_fold"), "folded")

    def one_fold(r: int, f: int) -> None:
        train = folded[r].where(F.col("_fold") != f).drop("_fold")
        test = folded[r].where(F.col("_fold") == f).drop("_fold")
        prep = build_preprocessor(exp.spec, exp.variant).fit(train)
        sides = {"test": materialize(prepared(prep, test, exp), "test")}
        train_rows = materialize(prepared(prep, train, exp), "train")
        if with_train:
            sides["train"] = train_rows
        balanced = train_rows
        if exp.sampler not in (None, "None", "Passthrough"):
            balanced = materialize(resample(train_rows, exp), "balanced")
        for c, params in enumerate(candidates):
            try:
                model = fit_model(exp.model, params, balanced, exp.seed)
                for side, rows in sides.items():
                    out = f"{base}/candidate={c}/repeat={r}/fold={f}/side={side}"
                    apply_model(model, rows, keep).write.parquet(out)
            except Exception as problem:  # one candidate must not stop the others
                failures[c] = f"candidate {c}, repeat {r}, fold {f}: {type(problem).__name__}: {problem}"

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for done in [pool.submit(one_fold, r, f) for r in range(repeats) for f in range(k)]:
            done.result()
    if candidates and len(failures) == len(candidates):
        raise RuntimeError("no candidate was fitted in every fold: " + "; ".join(failures[c] for c in sorted(failures)))
    schema = "key string, y_true int, y_pred int, y_prob double, candidate int, repeat int, fold int, side string"
    scored = spark.read.schema(schema).option("basePath", base).parquet(base)
    # Folds of a candidate that failed in another fold would give means over fewer rows than the others have.
    return scored.where(~F.col("candidate").isin(sorted(failures))) if failures else scored


def fold_metrics(scored: DataFrame) -> DataFrame:
    """All metrics of all candidates, repeats, folds and sides in one job."""
    return classification_metrics(scored, ["candidate", "repeat", "fold", "side"])


def cv_results(folds: DataFrame, candidates: Sequence[Mapping], metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per candidate with ``mean_``/``std_`` of every metric on both sides, its folds and parameters.

    A candidate that failed in some fold has fewer folds than the others and gets no means.
    """
    seen = folds.where("side = 'test'").groupBy("candidate").agg(F.count(F.lit(1)).alias("folds"))
    full = seen.agg(F.max("folds")).first()[0]
    whole = seen.where(F.col("folds") == full).select("candidate")
    long = metrics_long(folds.join(whole, "candidate", "left_semi"), ["candidate", "side"], metrics)
    summary = cv_summary(long, ["candidate", "side"])
    pieces = []
    for side in ("test", "train"):
        for m in metrics:
            hit = (F.col("side") == side) & (F.col("metric") == m)
            pieces.append(F.max(F.when(hit, F.col("mean"))).alias(f"mean_{side}_{m}"))
            pieces.append(F.max(F.when(hit, F.col("std"))).alias(f"std_{side}_{m}"))
    wide = summary.groupBy("candidate").agg(*pieces)
    spark = folds.sparkSession
    params = spark.createDataFrame(
        [(i, {k: str(v) for k, v in c.items()}) for i, c in enumerate(candidates)], "candidate int, params map<string,string>"
    )
    return seen.join(wide, "candidate", "left").join(params, "candidate")


@dataclass
class SearchResult:
    """Outcome of a grid search."""

    results: DataFrame
    best_index: int
    best_params: dict
    best_score: float
    passing_index: int | None
    passing_params: dict | None
    model: FittedPipeline | None
    runs: list


def different_candidates(exp: Experiment) -> tuple[list[dict], list[str]]:
    """(candidates that differ in a parameter the model has, names of the other parameters).

    Parameters without a counterpart would only fit the same model again, so of equal candidates the first is kept.
    """
    kept: dict[str, dict] = {}
    ignored: set[str] = set()
    for params in exp.candidates():
        used, others = split_params(exp.model, params)
        ignored.update(others)
        kept.setdefault(repr(sorted(used.items())), params)
    return list(kept.values()), sorted(ignored)


def grid_search(
    df: DataFrame,
    exp: Experiment,
    k: int = 5,
    repeats: int = 1,
    primary: str = "roc_auc",
    parallelism: int = 4,
    refit: bool = True,
    name: str | None = None,
    gates: Mapping[str, float] | None = None,
) -> SearchResult:
    """Cross-validate a grid, apply the fit gates, refit the best candidate, and describe every run.

    ``gates`` may override ``min_auc``, ``min_f1``, ``max_gap_auc`` and ``max_gap_f1``.
    """
    candidates, ignored = different_candidates(exp)
    failures: dict[int, str] = {}
    scored = cross_validate(df, exp, candidates, k, repeats, parallelism, failures=failures)
    folds = materialize(fold_metrics(scored), "foldmetrics")
    results = materialize(with_gates(cv_results(folds, candidates), **(gates or {})), "cv")
    rows = sorted(results.collect(), key=lambda r: r["candidate"])  # one row per candidate
    if all(r[f"mean_test_{primary}"] is None for r in rows):
        raise RuntimeError(f"no candidate has a value of {primary} in every fold")
    best = max(rows, key=lambda r: (r[f"mean_test_{primary}"] is not None, r[f"mean_test_{primary}"] or 0.0, -r["candidate"]))
    passing = best_passing(results.withColumn("_g", F.lit(0)), "_g").collect()
    chosen = passing[0]["candidate"] if passing else None
    model = fit_final(df, exp, candidates[best["candidate"]]) if refit else None
    name = name or exp.model
    parent = new_run(
        f"{name}__GRID",
        {**{f"grid_{p}": list(v) for p, v in exp.param_grid.items()}, **{f"best::{p}": v for p, v in candidates[best["candidate"]].items()}},
        {**_cell(best, "cv_best_"), f"cv_best_test_{primary}": best[f"mean_test_{primary}"]},
        {"stage": "grid-search", "model_cls": exp.model, "sampler": exp.sampler or "None", "cv_splits": k, "random_state": exp.seed, "ignored_params": ignored},
    )
    children = [
        new_run(
            f"{name}__cand_{r['candidate']}",
            {f"cand::{p}": v for p, v in candidates[r["candidate"]].items()},
            {**_cell(r, "cv_cand_"), "gate_gap_auc": r["gate_gap_auc"], "gate_gap_f1": r["gate_gap_f1"], "folds": r["folds"]},
            {
                "candidate_index": r["candidate"],
                "is_best": r["candidate"] == best["candidate"],
                "gate_underfit": r["gate_underfit"],
                "gate_overfit": r["gate_overfit"],
                "gate_passes": r["gate_passes"],
            },
            parent["run_id"],
        )
        for r in rows
    ]
    children += [
        new_run(
            f"{name}__cand_{c}",
            {f"cand::{p}": v for p, v in candidates[c].items()},
            tags={"candidate_index": c, "status": "FAILED", "error": problem},
            parent_id=parent["run_id"],
        )
        for c, problem in sorted(failures.items())
    ]
    return SearchResult(
        results, best["candidate"], candidates[best["candidate"]], best[f"mean_test_{primary}"],
        chosen, None if chosen is None else candidates[chosen], model, [parent, *children],
    )


def _cell(row, prefix: str) -> dict[str, float]:
    """Mean metrics of a result row under run-record names."""
    return {
        f"{prefix}{side}_{m}": row[f"mean_{side}_{m}"]
        for side in ("test", "train")
        for m in METRICS
        if row[f"mean_{side}_{m}"] is not None
    }


def out_of_fold(df: DataFrame, exp: Experiment, params: Mapping | None = None, k: int = 5, threshold: float | None = None) -> DataFrame:
    """(key, y_true, y_pred, y_prob): every row scored by the model that did not see it."""
    scored = cross_validate(df, exp, [dict(params or {})], k, 1, with_train=False)
    rows = scored.select("key", "y_true", "y_pred", "y_prob")
    if threshold is not None:
        rows = rows.withColumn("y_pred", (F.col("y_prob") >= F.lit(threshold)).cast("int"))
    return rows


def evaluate(
    df: DataFrame,
    exp: Experiment,
    name: str,
    params: Mapping | None = None,
    k: int = 5,
    repeats: int = 3,
    threshold: float | None = None,
    metrics: Sequence[str] = METRICS,
) -> tuple[DataFrame, DataFrame]:
    """(metric table with train and test cells, out-of-fold confusion matrix) of one configuration."""
    scored = cross_validate(df, exp, [dict(params or {})], k, repeats)
    summary = cv_summary(metrics_long(fold_metrics(scored), ["side"], metrics), ["side"])
    cells = []
    for side in ("train", "test"):
        at = F.col("side") == side
        cells += [
            F.max(F.when(at, F.col("text"))).alias(side),
            F.max(F.when(at, F.col("mean"))).alias(f"{side}_mean"),
            F.max(F.when(at, F.col("std"))).alias(f"{side}_std"),
        ]
    table = summary.groupBy("metric").agg(*cells).select(F.lit(name).alias("model"), "*")
    return table, confusion_matrix(out_of_fold(df, exp, params, k, threshold))


def train_and_record(
    df: DataFrame, exp: Experiment, name: str, params: Mapping | None = None, k: int = 5, repeats: int = 2
) -> tuple[dict, FittedPipeline, DataFrame]:
    """(run record with mean test scores, model fitted on all rows, out-of-fold confusion matrix)."""
    metrics = tuple(m for m in METRICS if m != "gmean")
    scored = cross_validate(df, exp, [dict(params or {})], k, repeats, with_train=False)
    means = cv_summary(metrics_long(fold_metrics(scored), ["side"], metrics), ["side"])
    scores = {r["metric"]: r["mean"] for r in means.collect()}
    run = new_run(
        name,
        {"model_class": exp.model, "sampler": exp.sampler or "None", "cv_splits": k, "cv_repeats": repeats, "random_state": exp.seed},
        scores,
    )
    return run, fit_final(df, exp, params), confusion_matrix(out_of_fold(df, exp, params, k))
