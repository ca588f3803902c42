"""End-to-end jobs on a small dirty file."""

import csv

import pytest
from pyspark.sql import functions as F

from riskloom.plans import jobs
from riskloom.sources import runs, tables
from riskloom.streaming.jobs import read_stream, score_stream

CONFIG = {
    "base": {"target_col": "risk", "random_state": 1},
    "data_cleaning": {
        "rename_cols": ["account", "months", "amount", "grade", "risk", "mixed"],
        "drop_cols": ["mixed"],
        "outlier_cols": {"months": 70},
        "test_size": 0.25,
        "random_state": 1,
    },
    "preprocessing": {
        "numeric": {"features": ["months", "amount"], "imputer_strategy": "mean"},
        "nominal": {"features": ["account"], "imputer_strategy": "most_frequent"},
        "ordinal": {"features": ["grade"], "imputer_strategy": "most_frequent"},
    },
    "grid_search": {"cv": 2, "n_repeats": 1, "scoring": "roc_auc"},
    "training": {
        "plain": {"name": "LogisticRegression", "resampler": "SMOTE", "param_grid": {"model__C": [0.1], "model__solver": ["liblinear"]}},
        "broken": {"name": "NoSuchModel", "resampler": None, "param_grid": {}},
    },
}


@pytest.fixture(scope="module")
def outcome(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    raw = folder / "raw.csv"
    with open(raw, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["laufkont", "laufzeit", "hoehe", "beszeit", "kredit", "x"])
        for i in range(160):
            good = int(i % 3 != 0)
            w.writerow([f"{1 + i % 4}" if i % 40 else "1WAL", 6 + i % 60 + (20 if good else 0), 900 + 37 * i if i % 11 else "nan", 1 + i % 5, good if i != 7 else "?", "junk"])
    config = {**CONFIG, "data": {"raw": str(raw)}}
    return jobs.full_job(spark, config, str(folder / "out")), str(folder / "out")


def test_clean_train_and_isolation(spark, outcome):
    done, folder = outcome
    train, test = spark.read.parquet(done["paths"]["train"]), spark.read.parquet(done["paths"]["test"])
    assert train.count() + test.count() == 159 and test.count() == 40
    assert done["status"]["plain"] == "finished", done["status"]
    assert done["status"]["broken"].startswith("failed: KeyError")
    table = runs.read_runs(spark, f"{folder}/runs")
    assert table.where(F.col("tags")["status"] == "FAILED").count() == 1
    best = table.where("run_name = 'plain'").first()
    assert {"best_cv_score", "avg_cv_roc_auc", "train_accuracy", "test_gmean"} <= set(best["metrics"])
    assert runs.latest_versions(spark.read.parquet(f"{folder}/models/_versions")).first()["version"] == 1


def test_champion_report_and_scoring(spark, outcome):
    done, folder = outcome
    test = spark.read.parquet(done["paths"]["test"])
    report = jobs.evaluate_champion(test, {"plain": done["experiments"]["plain"]}, f"{folder}/runs", f"{folder}/models", f"{folder}/report")
    assert report.first()["model"] == "plain"
    path = spark.read.parquet(f"{folder}/models/_versions").first()["tags"]["path"]
    out = jobs.score_job(spark, path, test, ["row_id"])
    assert out.count() == 40 and out.columns == ["row_id", "label", "value", "probability"]
    assert out.where("probability < 0.5 OR probability > 1").count() == 0


def test_version_numbers_grow(spark, tmp_path):
    path = str(tmp_path / "v")
    assert [runs.register_version(spark, path, "m", "r", {"a": 1}) for _ in range(3)] == [1, 2, 3]
    assert runs.by_alias(spark.read.parquet(path)).first()["version"] == 3


def test_loading_rules(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.load_table(spark, str(tmp_path / "x.xlsx"))
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    tables.append_rows(df, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        tables.append_rows(df.drop("s"), str(tmp_path / "t"), like=df)
    with pytest.raises(ValueError):
        tables.load_labelled(spark, str(tmp_path / "t"), "nope", df.schema)


def test_streamed_scores_are_not_repeated(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(50).withColumn("v", F.col("id") % 2)
    rows.write.parquet(f"{folder}/in")
    for _ in range(2):
        stream = read_stream(spark, f"{folder}/in", rows.schema)
        score_stream(stream, lambda b: b.withColumn("w", F.col("v") + 1), f"{folder}/out", f"{folder}/check").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 50


def test_content_keys_do_not_follow_partitions(spark):
    df = spark.createDataFrame([(i % 30, None if i % 4 else "a") for i in range(200)], "a int, b string")
    keyed = sorted(jobs.content_keys(df, "k").collect(), key=str)
    assert len({r["k"] for r in keyed}) == 200
    assert keyed == sorted(jobs.content_keys(df.repartition(7).orderBy("b"), "k").collect(), key=str)
