"""Queries for profiling, splits and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import profile, split
from riskloom.plans import data
from riskloom.plans.registry import query

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, columns, digits):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "table_info",
    f"""WITH a AS ({data.ACCOUNTS_SQL})
    SELECT 'row_id' AS "column", 'bigint' AS type, count(row_id) AS non_null FROM a
    UNION ALL SELECT 'amount', 'double', count(amount) FROM a UNION ALL SELECT 'term', 'double', count(term) FROM a
    UNION ALL SELECT 'priority', 'string', count(priority) FROM a UNION ALL SELECT 'status', 'string', count(status) FROM a
    UNION ALL SELECT 'grade', 'double', count(grade) FROM a UNION ALL SELECT 'y', 'int', count(y) FROM a""",
)
def table_info(spark, d):
    return profile.info(data.accounts(spark, d))


def _describe_sql(c: str, table: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, "
        f"round(quantile_cont({c}, 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {table}"
    )


@query("describe_numeric", " UNION ALL ".join(_describe_sql(c, "lineitem") for c in LINE_NUMBERS))
def describe_numeric(spark, d):
    df = profile.describe_numeric(data.read(spark, d, "lineitem"), LINE_NUMBERS)
    return rounded(df, ["mean", "std", "p25", "p50", "p75"], 4)


@query(
    "describe_with_nulls",
    f"WITH a AS ({data.ACCOUNTS_SQL}) " + " UNION ALL ".join(_describe_sql(c, "a") for c in ("amount", "term", "grade")),
)
def describe_with_nulls(spark, d):
    df = profile.describe_numeric(data.accounts(spark, d), ["amount", "term", "grade"])
    return rounded(df, ["mean", "std", "p25", "p50", "p75"], 4)


def _categorical_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", (SELECT count({c}) FROM a) AS count, (SELECT count(DISTINCT {c}) FROM a) AS \"unique\", "
        f"v AS top, n AS freq FROM (SELECT {c} AS v, count(*) AS n FROM a WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY n DESC, v LIMIT 1)"
    )


@query(
    "describe_categorical",
    f"WITH a AS ({data.ACCOUNTS_SQL}) SELECT * FROM (" + ") UNION ALL SELECT * FROM (".join(_categorical_sql(c) for c in ("priority", "status")) + ")",
)
def describe_categorical(spark, d):
    return profile.describe_categorical(data.accounts(spark, d), ["priority", "status"])


@query(
    "n_unique",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice")
    ),
)
def n_unique(spark, d):
    return profile.n_unique(data.read(spark, d, "lineitem"), ["l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice"])


@query(
    "value_counts",
    f"WITH a AS ({data.ACCOUNTS_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM a GROUP BY {c}"
        for c in ("priority", "status", "grade")
    ),
)
def value_counts(spark, d):
    return profile.value_counts(data.accounts(spark, d), ["priority", "status", "grade"], by="frequency")


@query(
    "null_counts",
    f"WITH a AS ({data.ACCOUNTS_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM a" for c in data.ACCOUNTS
    ),
)
def null_counts(spark, d):
    return profile.null_counts(data.accounts(spark, d))


@query(
    "class_balance",
    f"WITH a AS ({data.ACCOUNTS_SQL}) SELECT y, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 8) AS share FROM a GROUP BY y",
)
def class_balance(spark, d):
    return rounded(profile.class_balance(data.accounts(spark, d), "y"), ["share"], 8)


@query(
    "positive_share",
    f"""WITH a AS ({data.ACCOUNTS_SQL}) SELECT count(*) AS rows, sum(y)::BIGINT AS positives,
    round(avg(y) * 100, 6) AS positive_pct, round((1 - avg(y)) * 100, 6) AS negative_pct FROM a""",
)
def positive_share(spark, d):
    return rounded(profile.positive_share(data.accounts(spark, d), "y"), ["positive_pct", "negative_pct"], 6)


CORR = ["amount", "term", "grade", "y"]


@query(
    "correlation_matrix",
    f"WITH a AS ({data.ACCOUNTS_SQL}) "
    + " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 8) AS r FROM a" for x in CORR for y in CORR),
)
def correlation_matrix(spark, d):
    return rounded(profile.correlation(data.accounts(spark, d), CORR), ["r"], 8)


def _box_sql(c: str, table: str) -> str:
    return f"""
    SELECT '{c}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
      min(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END) AS whisker_low,
      max(CASE WHEN {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {c} END) AS whisker_high,
      count(CASE WHEN {c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
    FROM {table}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM {table})"""


@query("box_summary", _box_sql("value", "events") + " UNION ALL " + _box_sql("l_extendedprice", "lineitem"))
def box_summary(spark, d):
    a = profile.box_summary(data.read(spark, d, "events"), ["value"])
    b = profile.box_summary(data.read(spark, d, "lineitem"), ["l_extendedprice"])
    return rounded(a.unionByName(b), ["q1", "median", "q3"], 6)


@query(
    "outlier_points",
    """SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def outlier_points(spark, d):
    return profile.outlier_points(data.read(spark, d, "events"), "value").select("event_id", "value")


@query(
    "histogram",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    b AS (SELECT least(CAST(floor((l_extendedprice - lo) * 20.0e0 / (hi - lo)) AS INT), 19) AS bin, count(*) AS n
          FROM lineitem, s GROUP BY 1),
    g AS (SELECT CAST(range AS INT) AS bin FROM range(20))
    SELECT 'l_extendedprice' AS "column", g.bin, round(lo + g.bin * (hi - lo) / 20, 6) AS lower,
           round(lo + (g.bin + 1) * (hi - lo) / 20, 6) AS upper, coalesce(n, 0) AS n
    FROM g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin""",
)
def histogram(spark, d):
    return rounded(profile.histogram(data.read(spark, d, "lineitem"), ["l_extendedprice"]), ["lower", "upper"], 6)


@query(
    "density_curve",
    """WITH s AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h, min(value) AS lo, max(value) AS hi FROM events),
    g AS (SELECT CAST(range AS INT) AS point, lo + range * (hi - lo) / 49 AS x, n, h FROM range(50), s)
    SELECT point, round(any_value(x), 6) AS x, round(sum(exp(-0.5 * pow((value - x) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 8) AS density
    FROM g, events GROUP BY point""",
)
def density_curve(spark, d):
    return rounded(rounded(profile.density_curve(data.read(spark, d, "events"), "value"), ["x"], 6), ["density"], 8)


@query(
    "ordered_counts",
    f"""WITH raw AS ({data.RAW_SQL}), c AS (SELECT TRY_CAST(residence AS DOUBLE) AS code FROM raw)
    SELECT code, count(*) AS n FROM c WHERE code IS NOT NULL GROUP BY code""",
)
def ordered_counts(spark, d):
    return profile.ordered_counts(data.raw_named(spark, d), "residence")


# ---- splits ----------------------------------------------------------------------------------------

SPLIT_SQL = f"""
WITH a AS ({data.ACCOUNTS_SQL}),
c AS (SELECT y, count(*) AS n, sum(count(*)) OVER () AS total FROM a GROUP BY y),
w AS (SELECT y, n, ceil(total * 0.2) AS t, ceil(total * 0.2) * n / total AS exact FROM c),
f AS (SELECT *, floor(exact) AS base, row_number() OVER (ORDER BY floor(exact) - exact, y) AS place FROM w),
k AS (SELECT y, base + CASE WHEN place <= (SELECT any_value(t) - sum(base) FROM f) THEN 1 ELSE 0 END AS take FROM f),
r AS (SELECT row_id, a.y, row_number() OVER (PARTITION BY a.y ORDER BY md5('1:' || row_id)) AS i FROM a)
SELECT row_id, r.y, CASE WHEN i <= take THEN 'test' ELSE 'train' END AS split FROM r JOIN k ON r.y = k.y
"""


@query("stratified_split", SPLIT_SQL)
def stratified_split(spark, d):
    return split.stratified_split(data.accounts(spark, d), "y", "row_id", 0.2, 1).select("row_id", "y", "split")


@query(
    "split_by_status",
    SPLIT_SQL.replace("a.y", "a.status").replace("r.y", "r.status").replace("k.y", "k.status")
    .replace("SELECT y,", "SELECT status,").replace("GROUP BY y", "GROUP BY status").replace("exact, y)", "exact, status)"),
)
def split_by_status(spark, d):
    return split.stratified_split(data.accounts(spark, d), "status", "row_id", 0.2, 1).select("row_id", "status", "split")


def _fold_sql(seed: int, k: int) -> str:
    """Fold of each row: ranks in digest order cut into k runs whose sizes differ by at most one."""
    return f"""
    SELECT row_id, CASE WHEN i <= big * (size + 1) THEN (i - 1) // (size + 1) ELSE big + (i - 1 - big * (size + 1)) // size END AS fold
    FROM (SELECT row_id, row_number() OVER (PARTITION BY y ORDER BY md5('{seed}:' || row_id)) AS i,
                 count(*) OVER (PARTITION BY y) // {k} AS size, count(*) OVER (PARTITION BY y) % {k} AS big FROM a)"""


@query(
    "repeated_folds",
    f"""WITH a AS ({data.ACCOUNTS_SQL}), f0 AS ({_fold_sql(1, 5)}), f1 AS ({_fold_sql(2, 5)}), f2 AS ({_fold_sql(3, 5)})
    SELECT f0.row_id, CAST(f0.fold AS INT) AS fold_0, CAST(f1.fold AS INT) AS fold_1, CAST(f2.fold AS INT) AS fold_2
    FROM f0 JOIN f1 ON f0.row_id = f1.row_id JOIN f2 ON f0.row_id = f2.row_id""",
)
def repeated_folds(spark, d):
    return split.repeated_folds(data.accounts(spark, d), "y", "row_id", 5, 3, 1).select("row_id", "fold_0", "fold_1", "fold_2")


@query(
    "shuffled_folds",
    f"WITH a AS ({data.ACCOUNTS_SQL}), f AS ({_fold_sql(42, 5)}) SELECT row_id, CAST(fold AS INT) AS fold FROM f",
)
def shuffled_folds(spark, d):
    return split.stratified_folds(data.accounts(spark, d), "y", "row_id", 5, 42).select("row_id", "fold")


@query(
    "class_weights",
    f"""WITH a AS ({data.ACCOUNTS_SQL}), n AS (SELECT y, count(*) AS k, sum(count(*)) OVER () AS t, count(*) OVER () AS c FROM a GROUP BY y)
    SELECT a.y, round(any_value(t * 1.0e0 / (c * k)), 8) AS weight, count(*) AS n FROM a JOIN n ON a.y = n.y GROUP BY a.y""",
)
def class_weights(spark, d):
    df = split.with_class_weight(data.accounts(spark, d), "y")
    return df.groupBy("y").agg(F.round(F.first("weight"), 8).alias("weight"), F.count(F.lit(1)).alias("n"))


@query(
    "positive_weight",
    f"""WITH a AS ({data.ACCOUNTS_SQL}) SELECT count(*) AS n, round(sum(1 - y) * 1.0e0 / sum(y), 8) AS scale_pos_weight FROM a""",
)
def positive_weight(spark, d):
    df = data.accounts(spark, d)
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.lit(split.positive_weight(df, "y")), 8).alias("scale_pos_weight"))


@query(
    "union_of_parts",
    f"WITH a AS ({data.ACCOUNTS_SQL}) SELECT y, count(*) AS n, round(sum(amount), 2) AS amount FROM a GROUP BY y",
)
def union_of_parts(spark, d):
    train, test = split.train_test(data.accounts(spark, d), "y", "row_id", 0.3, 57)
    both = train.unionByName(test)
    return both.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))
