import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskloom.config import CleanSpec, FeatureSpec, clean_spec_from_dict
from riskloom.functions.text import WHITESPACE, strip_ends, to_num
from riskloom.operators import checks, clean

SPEC = CleanSpec(
    rename=("col_num", "col_str", "col_outlier", "col_rare", "target", "col_drop"),
    target="target",
    drop=("col_drop",),
    caps={"col_outlier": 100},
    features=FeatureSpec(numeric=("col_num", "col_outlier"), nominal=("col_str",), ordinal=("col_rare",)),
)
NINE = [
    ("1", " A ", "50", "rare1", "1.0"), ("2", "B", "150", "cat1", "0.0"), ("?", "NaN", "75", "cat1", "1.0"),
    ("4", "B", "invalid", "cat1", "error"), ("5", "B", "90", "cat1", "0.0"), ("6", "B", "95", "cat1", "1.0"),
    ("7", "B", "110", "cat1", "1.0"), ("8", "B", "80", "cat1", "0.0"), ("9", "B", "85", "cat1", "1.0"),
]


def table(spark, rows):
    keyed = [(i, *r, "x") for i, r in enumerate(rows)]
    return spark.createDataFrame(keyed, "row_id int, a string, b string, c string, d string, e string, f string")


@pytest.fixture(scope="module")
def cleaned(spark):
    out = clean.clean_data(table(spark, NINE), SPEC, keep=["row_id"])
    return sorted(out.collect(), key=lambda r: r["row_id"]), out


def test_shape_and_columns(cleaned):
    rows, df = cleaned
    assert df.columns == ["row_id", "col_num", "col_str", "col_outlier", "col_rare", "target"]
    assert len(rows) == 8


def test_numbers_caps_and_target(cleaned):
    rows, _ = cleaned
    assert [r["col_outlier"] for r in rows] == [50.0, None, 75.0, 90.0, 95.0, None, 80.0, 85.0]
    assert [r["target"] for r in rows] == [0, 1, 0, 1, 0, 0, 1, 0]
    assert {r["col_num"] for r in rows if r["col_num"] is not None} == {1.0, 2.0, 5.0, 6.0, 7.0, 8.0, 9.0}


def test_rare_values_are_counted_before_rows_are_dropped(cleaned):
    rows, _ = cleaned
    assert sum(r["col_str"] == "B" for r in rows) == 6
    assert sum(r["col_rare"] == "cat1" for r in rows) == 7
    assert rows[0]["col_str"] is None and rows[0]["col_rare"] is None


def test_two_runs_agree(spark, cleaned):
    again = clean.clean_data(table(spark, NINE), SPEC, keep=["row_id"]).collect()
    assert sorted(again) == cleaned[0]


def test_number_spellings(spark):
    cases = {
        "1": 1.0, "?": None, "": None, "invalid": None, "123": 123.0, " 2.5 ": 2.5, "1e3": 1000.0, "1d": None,
        "1f": None, "nan": None, "NaN": None, "-.5": -0.5, "+7": 7.0, "0x10": None, "inf": float("inf"), "1,5": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", to_num(F.col("t")).alias("x"))
    assert {r["t"]: r["x"] for r in df.collect()} == cases


@pytest.mark.parametrize("value,gone", [(50, False), (100, False), (101, True), (9999, True)])
def test_cap_is_strict(spark, value, gone):
    out = clean.cap_outliers(spark.createDataFrame([(float(value),)], "v double"), {"v": 100}).first()["v"]
    assert (out is None) == gone


def test_junk_spellings(spark):
    junk = ["NaN", "nan", "NAN", "null", "NULL", "na", "N/A", "n/a", "none", "None", "", "  NaN  ", "\tnull\n", " na　"]
    df = spark.createDataFrame([(j,) for j in junk] + [("B",), ("nano",)], "col_str string")
    out = [r[0] for r in clean.clean_text(df, ["col_str"], SPEC).collect()]
    assert out == [None] * len(junk) + ["B", "nano"]


def test_strip_matches_python(spark):
    texts = [f"{a}x y{b}" for a in ("", WHITESPACE, "é") for b in ("", WHITESPACE, "ñ")] + [WHITESPACE, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(strip_ends(F.col("t"))).collect()]
    assert got == [t.strip() for t in texts]


def test_rare_rule_paths_agree(spark, monkeypatch):
    values = ["a"] * 9 + ["b"] * 8 + ["c"] * 3 + [f"u{i}" for i in range(20)] + [None] * 2
    df = spark.createDataFrame([(v,) for v in values], "v string")
    want = sorted([v if v in ("a", "b") else None for v in values], key=str)
    assert sorted([r[0] for r in clean.null_rare(df, ["v"], 7).collect()], key=str) == want
    monkeypatch.setattr(clean, "INLINE_VALUES", 0)
    assert sorted([r[0] for r in clean.null_rare(df, ["v"], 7).collect()], key=str) == want


def test_rename_and_drop_fail_loudly(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        clean.rename_by_position(df, ["x"])
    with pytest.raises(ValueError):
        clean.drop_columns(df, ["nope"])


def test_strict_cast_fails_and_lenient_keeps_text(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("3", None, "7")], "a string, b string, c string")
    with pytest.raises(PySparkException):
        clean.to_integers_strict(df).collect()
    assert dict(clean.convert_if_all(df, df.columns).dtypes) == {"a": "bigint", "b": "double", "c": "string"}


def test_optional_drop_and_config(spark):
    config = {
        "base": {"target_col": "t"},
        "data_cleaning": {"rename_cols": ["a", "t"], "outlier_cols": {"a": 3}},
        "preprocessing": {"numeric": {"features": ["a"]}, "nominal": {"features": []}, "ordinal": {"features": []}},
    }
    spec = clean_spec_from_dict(config)
    out = clean.clean_data(spark.createDataFrame([("1", "1"), ("9", "0"), ("2", "z")], "x string, y string"), spec)
    assert sorted(out.collect(), key=str) == sorted([(1.0, 0), (None, 1)], key=str)


def test_quality_and_code_book(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (float("inf"), None)], "x double, s string")
    assert checks.quality_summary(df).first() == (3, 1, 1)
    book = checks.code_book(spark)
    assert book.count() == sum(len(labels) for labels in checks.CODE_LABELS.values())
    assert book.select("column").distinct().count() == 13


def test_missing_request_column_is_an_error(spark):
    with pytest.raises(ValueError):
        checks.check_requests(spark.createDataFrame([(1.0,)], "age double"))


def test_lenient_conversion_keeps_long_integers(spark):
    df = spark.createDataFrame([("9007199254740993", "5.0"), (" 9007199254740995", "1e3")], "a string, b string")
    out = clean.convert_if_all(df, df.columns)
    assert [tuple(r) for r in out.collect()] == [(9007199254740993, 5), (9007199254740995, 1000)]
    big = spark.createDataFrame([("99999999999999999999",)], "a string")
    assert clean.convert_if_all(big, ["a"]).dtypes == [("a", "double")]
