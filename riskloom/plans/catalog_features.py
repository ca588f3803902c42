"""Queries for feature stages."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import features as fe
from riskloom.plans import data
from riskloom.plans.catalog_profile import rounded
from riskloom.plans.registry import query

A = f"WITH a AS ({data.ACCOUNTS_SQL})"


def _fit(stage, df):
    return stage.fit(df).transform(df)


@query("impute_mean", f"{A} SELECT row_id, round(coalesce(amount, (SELECT avg(amount) FROM a)), 6) AS amount FROM a")
def impute_mean(spark, d):
    df = data.accounts(spark, d)
    out = _fit(fe.ValueImputer(inputCols=["amount"], outputCols=["filled"], option="mean"), df)
    return out.select("row_id", F.round("filled", 6).alias("amount"))


@query("impute_median", f"{A} SELECT row_id, round(coalesce(amount, (SELECT median(amount) FROM a)), 6) AS amount, coalesce(grade, (SELECT median(grade) FROM a)) AS grade FROM a")
def impute_median(spark, d):
    df = data.accounts(spark, d)
    out = _fit(fe.ValueImputer(inputCols=["amount", "grade"], outputCols=["f0", "f1"], option="median"), df)
    return out.select("row_id", F.round("f0", 6).alias("amount"), F.col("f1").alias("grade"))


@query(
    "impute_mode",
    f"""{A}, p AS (SELECT priority AS v FROM a WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1),
    g AS (SELECT grade AS v FROM a WHERE grade IS NOT NULL GROUP BY grade ORDER BY count(*) DESC, grade LIMIT 1)
    SELECT row_id, coalesce(priority, (SELECT v FROM p)) AS priority, coalesce(grade, (SELECT v FROM g)) AS grade FROM a""",
)
def impute_mode(spark, d):
    df = data.accounts(spark, d)
    out = _fit(fe.ValueImputer(inputCols=["priority", "grade"], outputCols=["f0", "f1"], option="most_frequent"), df)
    return out.select("row_id", F.col("f0").alias("priority"), F.col("f1").alias("grade"))


@query(
    "unit_scale",
    f"""{A}, s AS (SELECT min(amount) AS lo, max(amount) AS hi FROM a)
    SELECT row_id, round((amount - lo) / (hi - lo), 8) AS amount, 0.0 AS flat FROM a, s""",
)
def unit_scale(spark, d):
    df = data.accounts(spark, d).withColumn("one", F.lit(3.0))
    out = _fit(fe.UnitScaler(inputCols=["amount", "one"], outputCols=["u0", "u1"]), df)
    return out.select("row_id", F.round("u0", 8).alias("amount"), F.col("u1").alias("flat"))


@query(
    "z_scale",
    f"""{A}, s AS (SELECT avg(amount) AS m, stddev_pop(amount) AS sd FROM a) SELECT row_id, round((amount - m) / sd, 8) AS amount FROM a, s""",
)
def z_scale(spark, d):
    out = _fit(fe.ZScaler(inputCols=["amount"], outputCols=["z"]), data.accounts(spark, d))
    return out.select("row_id", F.round("z", 8).alias("amount"))


def _yj_sql(x: str, lam: float) -> str:
    up = f"ln(1 + {x})" if lam == 0 else f"(pow({x} + 1, {lam}) - 1) / {lam}"
    down = f"-ln(1 - {x})" if lam == 2 else f"-(pow(1 - {x}, {2 - lam}) - 1) / {2 - lam}"
    return f"CASE WHEN {x} >= 0 THEN {up} ELSE {down} END"


@query(
    "power_transform_fixed",
    "WITH e AS (SELECT event_id, (value - 50) / 100e0 AS x FROM events) SELECT event_id, "
    + ", ".join(f"round({_yj_sql('x', lam)}, 10) AS t{i}" for i, lam in enumerate((0.0, 0.5, 2.0, -1.5)))
    + " FROM e",
)
def power_transform_fixed(spark, d):
    x = (F.col("value") - 50) / 100.0
    df = data.read(spark, d, "events")
    return df.select("event_id", *[F.round(fe.yeo_johnson(x, lam), 10).alias(f"t{i}") for i, lam in enumerate((0.0, 0.5, 2.0, -1.5))])


@query("power_transform_fitted")
def power_transform_fitted(spark, d):
    df = data.read(spark, d, "events").select("event_id", (F.col("value") / 500.0).alias("x"))
    return _fit(fe.YeoJohnson(inputCols=["x"], outputCols=["t"]), df)


@query(
    "binary_encode",
    f"""{A}, t AS (SELECT row_id, coalesce(priority, 'nan') AS v FROM a), k AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM (SELECT DISTINCT v FROM t))
    SELECT row_id, (i >> 2) & 1 AS b_0, (i >> 1) & 1 AS b_1, i & 1 AS b_2 FROM t JOIN k ON t.v = k.v""",
)
def binary_encode(spark, d):
    df = data.accounts(spark, d)
    stages = Pipeline(stages=[fe.TextCast(inputCols=["priority"], outputCols=["text"]), fe.BinaryEncoder(inputCols=["text"], outputCols=["b"])])
    return _fit(stages, df).select("row_id", "b_0", "b_1", "b_2")


@query(
    "encode_by_table",
    """WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS v, o_custkey FROM orders),
    t AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT v FROM o WHERE o_custkey % 10 <> 0)),
    n AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS j FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 10 <> 0))
    SELECT o_orderkey, coalesce(i + 1, 0)::BIGINT AS code, coalesce(j, -1)::DOUBLE AS number FROM o LEFT JOIN t USING (v) LEFT JOIN n USING (o_custkey)""",
)
def encode_by_table(spark, d):
    """Codes of customers from a table of categories, as text and as numbers; every tenth customer is unknown to the stage."""
    df = data.read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("v"))
    known = df.where("o_custkey % 10 <> 0")
    bits = fe.BinaryEncoder(inputCols=["v"], outputCols=["b"], option="table").fit(known)
    index = fe.OrdinalIndex(inputCols=["o_custkey"], outputCols=["number"], option="table").fit(known)
    width = bits.widths()[0]
    code = sum((F.col(f"b_{k}").cast("long") * (1 << (width - 1 - k)) for k in range(width)), F.lit(0).cast("long"))
    return index.transform(bits.transform(df)).select("o_orderkey", code.alias("code"), "number")


@query(
    "binary_encode_many",
    """WITH k AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS v FROM orders)),
    w AS (SELECT length(bin(count(*))) AS w FROM k)
    SELECT o_orderkey, (i >> (w - 1)::INT) & 1 AS hi, i & 1 AS lo, lpad(bin(i), w::INT, '0') AS digits FROM orders JOIN k ON CAST(o_custkey AS VARCHAR) = v, w""",
)
def binary_encode_many(spark, d):
    df = fe.binary_encode_by_join(data.read(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "b")
    last = max(int(c[2:]) for c in df.columns if c.startswith("b_"))
    digits = F.concat(*[F.col(f"b_{k}").cast("int").cast("string") for k in range(last + 1)])
    return df.select("o_orderkey", F.col("b_0").alias("hi"), F.col(f"b_{last}").alias("lo"), digits.alias("digits"))


@query(
    "ordinal_index",
    f"""{A}, k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT priority AS v FROM a WHERE priority IS NOT NULL AND y = 1)),
    g AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT term AS v FROM a WHERE y = 1))
    SELECT row_id, coalesce(k.i, -1)::DOUBLE AS priority, coalesce(g.i, -1)::DOUBLE AS term
    FROM a LEFT JOIN k ON priority = k.v LEFT JOIN g ON term = g.v""",
)
def ordinal_index(spark, d):
    df = data.accounts(spark, d)
    model = fe.OrdinalIndex(inputCols=["priority", "term"], outputCols=["p", "t"]).fit(df.where("y = 1"))
    return model.transform(df).select("row_id", F.col("p").alias("priority"), F.col("t").alias("term"))


@query(
    "one_hot",
    f"""{A} SELECT row_id, (status = 'F')::INT::DOUBLE AS h0, (status = 'O')::INT::DOUBLE AS h1, 0.0 AS h_unseen FROM a WHERE status <> 'P'
    UNION ALL SELECT row_id, 0.0, 0.0, 0.0 FROM a WHERE status = 'P'""",
)
def one_hot(spark, d):
    df = data.accounts(spark, d)
    model = Pipeline(stages=fe.one_hot_stages(["status"], ["hot"])).fit(df.where("status <> 'P'"))
    out = model.transform(df).withColumn("h", vector_to_array("hot"))
    return out.select("row_id", F.col("h")[0].alias("h0"), F.col("h")[1].alias("h1"), F.coalesce(F.get("h", F.lit(2)), F.lit(0.0)).alias("h_unseen"))


def _prepared(spark, d, variant):
    df = data.accounts(spark, d)
    out = fe.build_preprocessor(data.ACCOUNT_SPEC, variant).fit(df).transform(df)
    return df, out


@query("preprocess_live")
def preprocess_live(spark, d):
    _, out = _prepared(spark, d, "live")
    return out.select("row_id", vector_to_array("features").alias("features"))


@query(
    "preprocess_extended",
    f"""{A}, m AS (SELECT median(amount) AS am, median(term) AS tm FROM a), f AS (SELECT *, coalesce(amount, am) AS a1, coalesce(term, tm) AS t1 FROM a, m),
    z AS (SELECT avg(a1) AS aa, stddev_pop(a1) AS asd, avg(t1) AS ta, stddev_pop(t1) AS tsd FROM f),
    p AS (SELECT priority AS v FROM a WHERE priority IS NOT NULL GROUP BY priority ORDER BY count(*) DESC, priority LIMIT 1),
    g AS (SELECT grade AS v FROM a WHERE grade IS NOT NULL GROUP BY grade ORDER BY count(*) DESC, grade LIMIT 1),
    x AS (SELECT row_id, (a1 - aa) / asd AS x0, (t1 - ta) / tsd AS x1, coalesce(grade, (SELECT v FROM g)) - 1 AS x2,
                 coalesce(priority, (SELECT v FROM p)) AS pr, status FROM f, z)
    SELECT row_id, round(x0, 8) AS x0, round(x1, 8) AS x1, x2, (pr = '1-URGENT')::INT::DOUBLE AS x3, (pr = '5-LOW')::INT::DOUBLE AS x7,
           (status = 'F')::INT::DOUBLE AS x8, (status = 'P')::INT::DOUBLE AS x10 FROM x""",
)
def preprocess_extended(spark, d):
    _, out = _prepared(spark, d, "extended")
    v = out.select("row_id", vector_to_array("features").alias("f"))
    return v.select("row_id", *[(F.round(F.col("f")[i], 8) if i < 2 else F.col("f")[i]).alias(f"x{i}") for i in (0, 1, 2, 3, 7, 8, 10)])


@query(
    "feature_width",
    f"""{A} SELECT 5 AS columns_before, (2 + length(bin(count(DISTINCT priority))) + length(bin(count(DISTINCT status))) + 1)::INT AS columns_after FROM a""",
)
def feature_width(spark, d):
    df, out = _prepared(spark, d, "notebook")
    return fe.width_report(df, out, len(data.ACCOUNT_SPEC.columns))


@query("numeric_cast_stage", f"WITH raw AS ({data.RAW_SQL}) SELECT target, round(sum(TRY_CAST(rate AS DOUBLE)), 6) AS rate FROM raw GROUP BY target")
def numeric_cast_stage(spark, d):
    df = fe.NumberCast(inputCols=["rate"], outputCols=["r"]).transform(data.raw_named(spark, d))
    return rounded(df.groupBy("target").agg(F.sum("r").alias("rate")), ["rate"], 6)
