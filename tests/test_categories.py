"""Encoders that hold their categories as a table: any number of them, same codes as from lists."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskloom.operators import features as fe


@pytest.fixture
def small(spark):
    rows = [(i, f"c{i % 37}" if i % 11 else None, float(i % 9) if i % 7 else None, "ß" if i % 2 else "z") for i in range(200)]
    return spark.createDataFrame(rows, "id int, t string, n double, u string")


def both(df, estimator, monkeypatch, other=None):
    """Rows encoded with lists and with a table."""
    out = []
    for held in (fe.HELD_CATEGORIES, 3):
        monkeypatch.setattr(fe, "HELD_CATEGORIES", held)
        out.append(sorted(map(str, estimator.fit(df).transform(df if other is None else other).select(sorted(estimator.fit(df).transform(df).columns)).collect())))
    return out


@pytest.mark.parametrize("kind", [fe.BinaryEncoder, fe.OrdinalIndex])
def test_table_and_lists_agree(small, kind, monkeypatch):
    stage = kind(inputCols=["t", "n", "u"], outputCols=["a", "b", "c"])
    other = small.unionByName(small.sparkSession.createDataFrame([(900, "new", 77.0, ""), (901, None, None, None)], small.schema))
    lists, table = both(small, stage, monkeypatch, other)
    assert lists == table and len(lists) == 202


def test_unknown_is_an_error_where_asked(small, monkeypatch):
    monkeypatch.setattr(fe, "HELD_CATEGORIES", 3)
    model = fe.OrdinalIndex(inputCols=["u"], outputCols=["c"], option="error").fit(small)
    assert model.transform(small).where("c < 0").count() == 0
    monkeypatch.setattr(fe, "HELD_CATEGORIES", 1)
    model = fe.OrdinalIndex(inputCols=["u"], outputCols=["c"], option="error").fit(small)
    with pytest.raises(Exception, match="unknown category"):
        model.transform(small.withColumn("u", F.lit("new"))).collect()


def test_saved_stage_carries_its_table(small, monkeypatch, tmp_path):
    monkeypatch.setattr(fe, "HELD_CATEGORIES", 3)
    model = Pipeline(stages=[fe.BinaryEncoder(inputCols=["t"], outputCols=["a"]), fe.OrdinalIndex(inputCols=["n"], outputCols=["b"])]).fit(small)
    model.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    assert str(tmp_path) in again.stages[0].fitted()["table"]
    columns = model.transform(small).columns
    assert sorted(map(str, again.transform(small).select(columns).collect())) == sorted(map(str, model.transform(small).collect()))


def test_two_hundred_thousand_categories(spark):
    df = spark.range(200_000).select(F.format_string("v%06d", "id").alias("t"), F.col("id"))
    model = fe.BinaryEncoder(inputCols=["t"], outputCols=["a"]).fit(df)
    assert isinstance(model.fitted(), dict) and model.widths() == [18]
    code = sum((F.col(f"a_{b}") * (1 << (17 - b)) for b in range(18)), F.lit(0))
    out = model.transform(df).select((code - F.col("id")).alias("gap"))
    assert out.groupBy("gap").count().collect() == [(1, 200_000)]
    assert len(model.getOrDefault("state")) < 1000


def test_a_table_where_asked_for(small):
    lists = fe.OrdinalIndex(inputCols=["t"], outputCols=["c"]).fit(small)
    table = fe.OrdinalIndex(inputCols=["t"], outputCols=["c"], option="table").fit(small)
    assert isinstance(table.fitted(), dict) and isinstance(lists.fitted(), list)
    assert sorted(table.transform(small).select("id", "c").collect()) == sorted(lists.transform(small).select("id", "c").collect())
