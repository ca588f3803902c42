"""Records under retries and several writers, and the evaluator inside Spark's tuning."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from riskloom.operators.evaluators import ScoreEvaluator
from riskloom.operators.metrics import METRICS, classification_metrics
from riskloom.operators.models import apply_model
from riskloom.sources import runs, tables


def test_two_writers_never_share_a_number(spark, tmp_path):
    path = f"{tmp_path}/versions"
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda i: runs.register_version(spark, path, "m" if i % 3 else "n/ä", f"r{i}"), range(12)))
    table = spark.read.schema(runs.VERSIONS_SCHEMA).parquet(path)
    rows = table.select("name", "version").collect()
    assert len(rows) == len(set(rows)) == 12 and sorted(v for i, v in enumerate(got) if i % 3) == list(range(1, 9))
    assert runs.register_version(spark, path, "m", "again") == 9
    assert runs.latest_versions(table).where("name = 'm'").first()["run_id"] is not None


def test_a_claim_whose_writer_failed_is_skipped(spark, tmp_path):
    path = f"{tmp_path}/versions"
    assert runs.register_version(spark, path, "m", "a") == 1
    claims = next((tmp_path / "versions" / "_claims").iterdir())
    assert runs.claim(spark, str(claims / "2")) and not runs.claim(spark, str(claims / "2"))
    assert runs.register_version(spark, path, "m", "b") == 3


def test_a_retry_leaves_one_record(spark, tmp_path):
    path = f"{tmp_path}/runs"
    first = [runs.new_run("a", {"C": 1}, {"auc": 0.5}, run_id="1"), runs.new_run("b", run_id="x y/z")]
    runs.log_runs(spark, first, path)
    runs.log_runs(spark, [runs.new_run("c", run_id="007")], path)
    runs.log_runs(spark, [runs.new_run("a", {"C": 1}, {"auc": 0.75}, run_id="1"), first[1]], path)
    runs.log_runs(spark, [], path)
    got = {r["run_id"]: r for r in runs.read_runs(spark, path).collect()}
    assert sorted(got) == ["007", "1", "x y/z"] and runs.read_runs(spark, path).count() == 3
    assert got["1"]["metrics"] == {"auc": 0.75} and got["1"]["params"] == {"C": "1"}
    assert runs.read_runs(spark, path).columns == [f.split()[0] for f in runs.RUNS_SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(f"k{i}", Vectors.dense([float(i % 13), float(i % 7)]), float((i % 13) + (i % 5) > 9)) for i in range(260)]
    df = spark.createDataFrame(rows, ["key", "features", "label"])
    return df, LogisticRegression(maxIter=20).fit(df)


def test_evaluator_equals_the_metrics(scored):
    df, model = scored
    want = classification_metrics(apply_model(model, df, [F.col("label").cast("int").alias("y_true")])).first()
    for name in METRICS:
        assert ScoreEvaluator(metricName=name).evaluate(model.transform(df)) == pytest.approx(want[name])
    with pytest.raises(ValueError):
        ScoreEvaluator(metricName="luck")
    with pytest.raises(ValueError):
        ScoreEvaluator().evaluate(model.transform(df).drop("probability"))
    assert ScoreEvaluator().evaluate(model.transform(df.where("label = 1"))) == 0.0


def test_evaluator_in_a_tuning_split(scored, tmp_path):
    df, _ = scored
    lr = LogisticRegression(maxIter=10)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 1000.0]).build()
    found = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=ScoreEvaluator(metricName="gmean"), trainRatio=0.7, seed=3).fit(df)
    assert found.validationMetrics[0] > found.validationMetrics[1] == 0.0
    ScoreEvaluator(metricName="f1").write().overwrite().save(f"{tmp_path}/e")
    assert ScoreEvaluator.load(f"{tmp_path}/e").getOrDefault("metricName") == "f1"


def test_checksum_of_a_data_set_follows_rows_not_their_order(spark):
    rows = [(1, "a", 0.5), (2, None, 1.5), (2, None, 1.5), (3, "c", None)]

    def checksum(values, parts):
        return tables.fingerprint(spark.createDataFrame(values, "i long, t string, x double").repartition(parts), "given", "t").first()

    first = checksum(rows, 1)
    assert (first["rows"], first["columns"], first["checksum"]) == (4, 3, checksum(rows[::-1], 3)["checksum"])
    others = [rows[:3], [*rows, rows[0]], [(9, "a", 0.5), *rows[1:]], [(1, "b", 0.5), *rows[1:]], [(1, "a", 0.25), *rows[1:]], [(2, "a", 0.5), (1, None, 1.5), *rows[2:]]]
    assert len({first["checksum"], *(checksum(o, 2)["checksum"] for o in others)}) == len(others) + 1
    assert checksum([], 1)["rows"] == 0
