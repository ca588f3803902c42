"""The four end-to-end jobs: clean, train, score, watch for drift, and choose a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import CleanSpec, FeatureSpec, clean_spec_from_dict
from riskloom.operators import metrics, search, select
from riskloom.operators.clean import clean_data
from riskloom.operators.drift import inject_drift, monitor
from riskloom.operators.score import label_predictions
from riskloom.operators.select import METRIC_PREFERENCE
from riskloom.runtime import materialize
from riskloom.sources import models, runs, tables


def content_keys(df: DataFrame, key: str) -> DataFrame:
    """Add a unique text key: a digest of all columns and the number of the row among its equals.

    Equal rows are counted with map-side combine and written out again from their count, so a row that fills a third
    of the table is no hot group.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    digest = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    numbered = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return numbered.withColumn(key, F.concat_ws(":", digest, F.col("_copy").cast("string"))).drop("_copies", "_copy")


def clean_job(
    spark: SparkSession, source: str, folder: str, spec: CleanSpec, test_size: float = 0.2, seed: int = 1, key: str = "row_id"
) -> dict[str, str]:
    """Load, clean, split and save; a failure stops the job instead of leaving stale files.

    A source with the column ``key`` keeps it. Other rows get a digest of their content and, for equal rows, a number,
    so that the split does not depend on files, partitions or row order.
    """
    raw = tables.load_table(spark, source)
    if key not in raw.columns:
        raw = content_keys(raw, key)
    landed = materialize(raw.select(key, *[c for c in raw.columns if c != key]), "raw")
    clean = materialize(clean_data(landed, spec, keep=[key]), "clean")
    return tables.save_splits(clean, folder, spec.target, key, test_size, seed, fmt="parquet")


def train_job(
    train: DataFrame,
    test: DataFrame,
    experiments: Mapping[str, search.Experiment],
    runs_path: str,
    models_path: str,
    k: int = 5,
    repeats: int = 3,
    parallelism: int = 4,
    primary: str = "roc_auc",
) -> dict[str, str]:
    """Grid search, final fit, train and hold-out metrics, run records and saved model per experiment.

    A failing experiment is recorded and does not stop the others. Returns status per experiment.
    """
    spark = train.sparkSession
    train, test = materialize(train, "train"), materialize(test, "holdout")
    status = {}
    for name, exp in experiments.items():
        try:
            found = search.grid_search(train, exp, k, repeats, primary, parallelism, refit=True, name=name)
            sides = search.score_labelled(found.model, train, exp).withColumn("phase", F.lit("train")).unionByName(
                search.score_labelled(found.model, test, exp).withColumn("phase", F.lit("test"))
            )
            scored = materialize(sides, "scored")
            by_phase = {r["phase"]: r.asDict() for r in metrics.evaluate_phases(scored).collect()}
            best = found.results.where(F.col("candidate") == found.best_index).first()
            record = runs.new_run(
                name,
                found.best_params,
                {
                    "best_cv_score": found.best_score,
                    **{f"avg_cv_{m}": best[f"mean_test_{m}"] for m in metrics.METRICS},
                    **{f"std_cv_{m}": best[f"std_test_{m}"] for m in metrics.METRICS},
                    **{k2: v for p, row in by_phase.items() for k2, v in runs.phase_metrics(row, p).items()},
                },
                {"model_name": exp.model, "resampler": exp.sampler or "None", "cv_splits": k, "cv_repeats": repeats},
            )
            runs.log_runs(spark, [record, *found.runs], runs_path)
            path = f"{models_path}/{name}/{record['run_id']}"
            inputs = train.select(*exp.spec.columns)
            models.save_model(found.model, path, inputs)
            runs.register_version(
                spark, f"{models_path}/_versions", f"{exp.model}_model", record["run_id"], {"path": path, "run_name": name}
            )
            status[name] = "finished"
        except Exception as problem:
            status[name] = f"failed: {type(problem).__name__}: {problem}"
            runs.log_runs(spark, [runs.new_run(name, tags={"status": "FAILED", "error": str(problem)})], runs_path)
    return status


def evaluate_champion(
    test: DataFrame, experiments: Mapping[str, search.Experiment], runs_path: str, models_path: str, report: str, primary: str = "roc_auc"
) -> DataFrame:
    """Metrics of the run with the best cross-validated score on the hold-out table, written as a report."""
    spark = test.sparkSession
    best = select.champion(runs.read_runs(spark, runs_path), f"avg_cv_{primary}")
    exp = experiments[best["run_name"]]
    model = models.load_model(spark, f"{models_path}/{best['run_name']}/{best['run_id']}")
    scored = materialize(search.score_labelled(model, test, exp), "final")
    found = metrics.classification_metrics(scored).withColumn("model", F.lit(best["run_name"]))
    tables.write_metrics(found, report)
    return spark.read.json(report)


def full_job(spark: SparkSession, config: dict, folder: str, experiments=None, parallelism: int = 4) -> dict:
    """Clean, train and evaluate from one configuration mapping."""
    spec = clean_spec_from_dict(config)
    split = config["data_cleaning"]
    paths = clean_job(spark, config["data"]["raw"], f"{folder}/data", spec, split.get("test_size", 0.2), split.get("random_state", 1))
    train, test = spark.read.parquet(paths["train"]), spark.read.parquet(paths["test"])
    experiments = experiments or experiments_from_dict(config, spec.features, spec.target)
    search_cfg = config.get("grid_search", {})
    status = train_job(
        train, test, experiments, f"{folder}/runs", f"{folder}/models",
        search_cfg.get("cv", 5), search_cfg.get("n_repeats", 3), parallelism, search_cfg.get("scoring", "roc_auc"),
    )
    return {"paths": paths, "status": status, "experiments": experiments}


def experiments_from_dict(config: dict, spec: FeatureSpec, target: str, key: str = "row_id") -> dict[str, search.Experiment]:
    """The ``training`` section of a configuration as experiments."""
    return {
        name: search.Experiment(
            model=c["name"], spec=spec, label=target, key=key, param_grid=c.get("param_grid", {}),
            sampler=c.get("resampler"), sampler_params=c.get("resampler_params", {}),
            seed=config.get("base", {}).get("random_state", 1),
        )
        for name, c in config["training"].items()
    }


def score_job(spark: SparkSession, model_path: str, requests: DataFrame, keep: Sequence[str], key: str | None = None) -> DataFrame:
    """Label, class and probability for a table of requests."""
    model = models.load_model(spark, model_path)
    if key is not None and key != "key":
        requests = requests.withColumn("key", F.col(key).cast("string"))
    out = model.transform(requests)
    if "y_prob" in out.columns:
        out = out.withColumns({"prediction": F.col("y_pred"), "probability": F.array(1 - F.col("y_prob"), F.col("y_prob"))})
    return label_predictions(out, list(keep))


def drift_job(
    reference: DataFrame, key: str, log_path: str, intensity: float = 0.25, seed: int = 42,
    target: str | None = None, exclude: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Simulate drift on a table, test it and append the verdict to the log: (log row, change log)."""
    drifted, changes = inject_drift(reference, key, intensity, seed, target, exclude)
    columns = [c for c in reference.columns if c != key]
    record = monitor(reference.select(*columns), materialize(drifted.select(*columns), "drifted"), log_path, "simulation", target)
    return record, changes


def select_job(run_table: DataFrame, whitelist: Sequence[str] | None = None, order: Sequence[str] = METRIC_PREFERENCE) -> dict[str, DataFrame]:
    """Winners per group, groups without a passing run, and the overall winner."""
    children = materialize(select.name_children(run_table, whitelist), "children")
    table = materialize(select.winners(children, order), "winners")
    return {
        "winners": select.sort_winners(table),
        "failed": select.failed_groups(children),
        "overall": select.overall_winner(table, order),
    }

