"""Queries for cleaning, checks and code books."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.config import JUNK_TEXTS
from riskloom.operators import checks, clean, profile
from riskloom.operators.checks import CODE_LABELS, REQUEST_COLUMNS, REQUEST_RANGES
from riskloom.plans import data
from riskloom.plans.registry import query
from riskloom.runtime import scratch_path

JUNK_SQL = ", ".join(f"'{w}'" for w in JUNK_TEXTS)


def trimmed(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '^\s+', ''), '\s+$', '')"


def junk_free(c: str) -> str:
    return f"CASE WHEN lower({c}) NOT IN ({JUNK_SQL}) THEN {c} END"


def number(c: str) -> str:
    """Lenient number: null for text that is no number and for NaN."""
    cast = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return f"CASE WHEN NOT isnan({cast}) THEN {cast} END"


def capped(c: str, cap: float) -> str:
    return f"CASE WHEN {c} <= {cap} THEN {c} END"


CLEANED_TEXT = f"""
raw AS ({data.RAW_SQL}),
txt AS (
  SELECT {number('amount')} AS amount0, {number('term')} AS term0, {number('rate')} AS rate,
         {trimmed('purpose')} AS p0, {trimmed('residence')} AS r0, target
  FROM raw),
junked AS (
  SELECT {capped('amount0', 90000.0)} AS amount, {capped('term0', 45.0)} AS term, rate,
         {junk_free('p0')} AS p1, {junk_free('r0')} AS r1, target
  FROM txt)"""

CLEAN_SQL = f"""
WITH {CLEANED_TEXT},
counted AS (
  SELECT *, CASE WHEN p1 IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY p1) END AS pn,
            CASE WHEN r1 IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY r1) END AS rn
  FROM junked)
SELECT amount, term, rate, CASE WHEN pn >= 7 THEN p1 END AS purpose, CASE WHEN rn >= 7 THEN r1 END AS residence,
       CASE WHEN TRY_CAST(target AS DOUBLE) = 1 THEN 0 ELSE 1 END AS target
FROM counted WHERE TRY_CAST(target AS DOUBLE) IN (0.0, 1.0)
"""


@query("clean_applications", CLEAN_SQL)
def clean_applications(spark, d):
    return clean.clean_data(data.raw(spark, d), data.RAW_SPEC)


@query(
    "clean_class_balance",
    f"""WITH c AS ({CLEAN_SQL})
    SELECT target, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 8) AS share FROM c GROUP BY target""",
)
def clean_class_balance(spark, d):
    df = clean.clean_data(data.raw(spark, d), data.RAW_SPEC)
    return profile.class_balance(df, "target").withColumn("share", F.round("share", 8))


@query(
    "clean_notebook_variant",
    f"""WITH raw AS ({data.RAW_SQL}),
    txt AS (
      SELECT {number('amount')} AS a0, {number('term')} AS t0, {number('rate')} AS rate,
             regexp_replace(purpose, '\\s+', '', 'g') AS p1, regexp_replace(residence, '\\s+', '', 'g') AS r1, target FROM raw),
    counted AS (SELECT *, count(*) OVER (PARTITION BY p1) AS pn, count(*) OVER (PARTITION BY r1) AS rn FROM txt)
    SELECT {capped('a0', 100000.0)} AS amount, {capped('t0', 48.0)} AS term, rate,
           CASE WHEN pn >= 7 THEN p1 END AS purpose, CASE WHEN rn >= 7 THEN r1 END AS residence,
           CASE WHEN TRY_CAST(target AS DOUBLE) = 1 THEN 0 ELSE 1 END AS target
    FROM counted WHERE TRY_CAST(target AS DOUBLE) IN (0.0, 1.0)""",
)
def clean_notebook_variant(spark, d):
    spec = data.RAW_SPEC.notebook_variant({"amount": 100000.0, "term": 48.0})
    return clean.clean_data(data.raw(spark, d), spec)


@query(
    "rename_by_position",
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer",
)
def rename_by_position(spark, d):
    df = clean.rename_by_position(data.read(spark, d, "customer"), ["id", "name", "nation", "balance", "segment"])
    return clean.drop_columns(df, ["nation"])


@query(
    "trim_and_junk_text",
    f"""WITH {CLEANED_TEXT}
    SELECT 'purpose' AS "column", p1 AS value, count(*) AS n FROM junked GROUP BY p1
    UNION ALL SELECT 'residence', r1, count(*) FROM junked GROUP BY r1""",
)
def trim_and_junk_text(spark, d):
    df = clean.clean_text(data.raw_named(spark, d), ["purpose", "residence"], data.RAW_SPEC)
    return clean.value_counts_long(df, ["purpose", "residence"])


@query(
    "remove_all_whitespace",
    f"""WITH raw AS ({data.RAW_SQL})
    SELECT regexp_replace(purpose, '\\s+', '', 'g') AS purpose, count(*) AS n FROM raw GROUP BY 1""",
)
def remove_all_whitespace(spark, d):
    spec = data.RAW_SPEC.notebook_variant({})
    df = clean.clean_text(data.raw_named(spark, d), ["purpose"], spec)
    return df.groupBy("purpose").agg(F.count(F.lit(1)).alias("n"))


@query(
    "coerce_numeric",
    f"""WITH raw AS ({data.RAW_SQL})
    SELECT target, count({number('amount')}) AS n_amount, round(sum({number('amount')}), 2) AS sum_amount,
           count({number('term')}) AS n_term, round(sum({number('term')}), 2) AS sum_term FROM raw GROUP BY target""",
)
def coerce_numeric(spark, d):
    df = clean.coerce_numeric(data.raw_named(spark, d), ["amount", "term"])
    return df.groupBy("target").agg(
        F.count("amount").alias("n_amount"),
        F.round(F.sum("amount"), 2).alias("sum_amount"),
        F.count("term").alias("n_term"),
        F.round(F.sum("term"), 2).alias("sum_term"),
    )


@query(
    "convert_if_all",
    f"""WITH raw AS ({data.RAW_SQL})
    SELECT 'amount' AS "column", 'string' AS type, count(amount) AS non_null FROM raw
    UNION ALL SELECT 'rate', 'double', count(rate) FROM raw
    UNION ALL SELECT 'line', 'bigint', count(l_linenumber) FROM lineitem
    UNION ALL SELECT 'purpose', 'string', count(purpose) FROM raw""",
)
def convert_if_all(spark, d):
    columns = dict(zip(data.RAW_NAMES, data.RAW.values()))
    wanted = {n: columns[n] for n in ("amount", "rate", "purpose")} | {"line": "CAST(l_linenumber AS STRING)"}
    df = data.read(spark, d, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in wanted.items()])
    return profile.info(clean.convert_if_all(df, list(wanted)))


@query(
    "strict_integers",
    "SELECT CAST(l_quantity AS BIGINT) AS quantity, CAST(l_linenumber AS BIGINT) AS line, count(*) AS n "
    "FROM lineitem GROUP BY 1, 2",
)
def strict_integers(spark, d):
    df = data.read(spark, d, "lineitem").select(
        F.col("l_quantity").cast("string").alias("quantity"), F.col("l_linenumber").cast("string").alias("line")
    )
    numbers = clean.to_integers_strict(df.select(F.col("quantity").cast("double").alias("quantity"), "line"))
    return numbers.groupBy("quantity", "line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cap_outliers",
    "SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_quantity <= 45 THEN 1 END) AS kept, "
    "max(CASE WHEN l_quantity <= 45 THEN l_quantity END) AS top FROM lineitem GROUP BY l_returnflag",
)
def cap_outliers(spark, d):
    df = clean.cap_outliers(data.read(spark, d, "lineitem"), {"l_quantity": 45.0})
    return df.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_quantity").alias("kept"), F.max("l_quantity").alias("top")
    )


@query(
    "rare_to_null",
    f"""WITH raw AS ({data.RAW_SQL}), n AS (SELECT purpose, count(*) AS k FROM raw GROUP BY purpose)
    SELECT CASE WHEN k >= 7 THEN purpose END AS purpose, sum(k)::BIGINT AS n FROM n GROUP BY 1""",
)
def rare_to_null(spark, d):
    df = clean.null_rare(data.raw_named(spark, d), ["purpose"], 7)
    return df.groupBy("purpose").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rare_share_to_null",
    """WITH n AS (SELECT p_brand, count(*) AS k, sum(count(*)) OVER () AS total FROM part GROUP BY p_brand)
    SELECT CASE WHEN k >= 7 AND k >= 0.04 * total THEN p_brand END AS p_brand, sum(k)::BIGINT AS n FROM n GROUP BY 1""",
)
def rare_share_to_null(spark, d):
    df = clean.null_rare(data.read(spark, d, "part"), ["p_brand"], 7, min_share=0.04)
    return df.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query(
    "valid_target_audit",
    f"""WITH raw AS ({data.RAW_SQL})
    SELECT count(*) AS rows_before, count(CASE WHEN TRY_CAST(target AS DOUBLE) IN (0.0, 1.0) THEN 1 END) AS rows_kept,
           count(CASE WHEN coalesce(TRY_CAST(target AS DOUBLE), -1) NOT IN (0.0, 1.0) THEN 1 END) AS rows_dropped FROM raw""",
)
def valid_target_audit(spark, d):
    return clean.dropped_by_target(data.raw_named(spark, d), "target")


@query(
    "valid_target_written",
    f"""WITH raw AS ({data.RAW_SQL}), c AS (SELECT count(*) AS rows_before, count(CASE WHEN TRY_CAST(target AS DOUBLE) IN (0.0, 1.0) THEN 1 END) AS rows_kept FROM raw)
    SELECT rows_before, rows_kept, rows_before - rows_kept AS rows_dropped, 1000 AS expected, rows_before = 1000 AS unchanged, rows_kept AS rows_stored FROM c""",
)
def valid_target_written(spark, d):
    """Counts observed while writing, beside the rows that the written table holds."""
    path = scratch_path(spark, "valid")
    audit = clean.write_valid(data.raw_named(spark, d), "target", path, expected=1000)
    return audit.crossJoin(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_stored")))


@query(
    "valid_target_inverted",
    f"""WITH raw AS ({data.RAW_SQL})
    SELECT CASE WHEN TRY_CAST(target AS DOUBLE) = 1 THEN 0 ELSE 1 END AS target, count(*) AS n
    FROM raw WHERE TRY_CAST(target AS DOUBLE) IN (0.0, 1.0) GROUP BY 1""",
)
def valid_target_inverted(spark, d):
    df = clean.invert_target(clean.valid_target(data.raw_named(spark, d), "target"), "target")
    return df.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("drop_null_target", f"WITH a AS ({data.ACCOUNTS_SQL}) SELECT row_id, priority FROM a WHERE priority IS NOT NULL")
def drop_null_target(spark, d):
    return clean.drop_null_target(data.accounts(spark, d), "priority").select("row_id", "priority")


@query(
    "reset_index",
    'SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS "index" FROM orders WHERE o_orderstatus = \'F\'',
)
def reset_index(spark, d):
    df = data.read(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return clean.reset_index(df, "o_orderkey")


@query(
    "column_presence",
    """SELECT 'l_quantity' AS "column", count(l_quantity) > 0 AS present, 'double' AS type FROM lineitem
    UNION ALL SELECT 'l_returnflag', count(l_returnflag) > 0, 'string' FROM lineitem
    UNION ALL SELECT 'age', false, NULL FROM (SELECT 1)""",
)
def column_presence(spark, d):
    return checks.missing_columns(data.read(spark, d, "lineitem"), ["l_quantity", "l_returnflag", "age"])


def _violations_sql() -> str:
    parts = []
    for c in REQUEST_COLUMNS:
        parts.append(f"CASE WHEN {c} IS NULL THEN '{c}:missing' END")
        if c in REQUEST_RANGES:
            low, high = REQUEST_RANGES[c]
            bad = f"{c} < {low}" if high is None else f"{c} < {low} OR {c} > {high}"
            parts.append(f"CASE WHEN {bad} THEN '{c}:range' END")
        if c in CODE_LABELS:
            codes = ", ".join(str(code) for code in CODE_LABELS[c])
            parts.append(f"CASE WHEN {c} NOT IN ({codes}) THEN '{c}:code' END")
    return "concat_ws('|', " + ", ".join(parts) + ")"


@query(
    "request_contract",
    f"""WITH r AS ({data.REQUESTS_SQL}), v AS (SELECT row_id, {_violations_sql()} AS found FROM r)
    SELECT row_id, found AS violations, found = '' AS accepted FROM v""",
)
def request_contract(spark, d):
    checked = checks.check_requests(data.requests(spark, d))
    return checked.select("row_id", F.concat_ws("|", "violations").alias("violations"), "accepted")


@query(
    "request_split",
    f"""WITH r AS ({data.REQUESTS_SQL}), v AS (SELECT *, {_violations_sql()} = '' AS ok FROM r)
    SELECT CASE WHEN ok THEN 'accepted' ELSE 'quarantined' END AS part, count(*) AS n, round(sum(amount), 2) AS amount
    FROM v GROUP BY 1""",
)
def request_split(spark, d):
    good, bad = checks.split_requests(data.requests(spark, d))
    both = good.select(F.lit("accepted").alias("part"), "amount").unionByName(
        bad.select(F.lit("quarantined").alias("part"), "amount")
    )
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


def _decode_sql(column: str) -> str:
    cases = " ".join(f"WHEN {code} THEN '{label}'" for code, label in CODE_LABELS[column].items())
    return f"CASE {column} {cases} END"


@query(
    "decode_codes",
    f"WITH r AS ({data.REQUESTS_SQL}) SELECT row_id, {_decode_sql('purpose')} AS purpose_label, "
    f"{_decode_sql('housing')} AS housing_label FROM r",
)
def decode_codes(spark, d):
    df = checks.decode(checks.decode(data.requests(spark, d), "purpose"), "housing")
    return df.select("row_id", "purpose_label", "housing_label")


@query(
    "encode_labels",
    f"WITH r AS ({data.REQUESTS_SQL}) SELECT row_id, CASE WHEN purpose <= 10 THEN purpose END AS purpose_code FROM r",
)
def encode_labels(spark, d):
    df = checks.decode(data.requests(spark, d), "purpose", name="label")
    return checks.encode_labels(df.select("row_id", F.col("label").alias("purpose")), "purpose").select("row_id", "purpose_code")


@query(
    "code_book_join",
    "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def code_book_join(spark, d):
    book = data.read(spark, d, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    df = checks.decode(data.read(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", book, "nation")
    return df.select("c_custkey", "nation")


@query(
    "columns_by_type",
    "SELECT round(sum(l_orderkey + l_partkey + l_suppkey + l_linenumber + l_quantity + l_extendedprice + l_discount + l_tax), 2) "
    "AS numeric_total, count(DISTINCT (l_returnflag, l_linestatus, l_shipdate)) AS other_values FROM lineitem",
)
def columns_by_type(spark, d):
    df = data.read(spark, d, "lineitem")
    total = sum((F.col(c) for c in clean.columns_by_type(df, True)), F.lit(0))
    return df.agg(
        F.round(F.sum(total), 2).alias("numeric_total"),
        F.count_distinct(*[F.col(c) for c in clean.columns_by_type(df, False)]).alias("other_values"),
    )


@query(
    "model_column_order",
    f"WITH r AS ({data.REQUESTS_SQL}) SELECT {', '.join(REQUEST_COLUMNS)} FROM r",
)
def model_column_order(spark, d):
    return checks.in_order(data.requests(spark, d), REQUEST_COLUMNS)


@query(
    "preview_first_rows",
    """WITH h AS (SELECT s_name, s_nationkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS i FROM supplier)
    SELECT 's_name' AS "column", max(CASE WHEN i = 1 THEN s_name END) AS row_0, max(CASE WHEN i = 2 THEN s_name END) AS row_1,
           max(CASE WHEN i = 3 THEN s_name END) AS row_2 FROM h
    UNION ALL SELECT 's_nationkey', max(CASE WHEN i = 1 THEN CAST(s_nationkey AS VARCHAR) END),
           max(CASE WHEN i = 2 THEN CAST(s_nationkey AS VARCHAR) END), max(CASE WHEN i = 3 THEN CAST(s_nationkey AS VARCHAR) END) FROM h""",
)
def preview_first_rows(spark, d):
    df = data.read(spark, d, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").select("s_name", "s_nationkey")
    return profile.preview(df, 3)


@query(
    "quality_checks",
    """WITH g AS (SELECT l_returnflag, l_linestatus, l_quantity, l_discount, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT sum(n)::BIGINT AS rows, (sum(n) - count(*))::BIGINT AS duplicate_rows, 0::BIGINT AS infinite_values FROM g""",
)
def quality_checks(spark, d):
    df = data.read(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    return checks.quality_summary(df)


@query(
    "frequency_of_value",
    "SELECT l_shipdate, l_returnflag, count(*) OVER (PARTITION BY l_shipdate) AS frequency FROM lineitem",
)
def frequency_of_value(spark, d):
    df = data.read(spark, d, "lineitem").select("l_shipdate", "l_returnflag")
    return profile.frequency_of_value(df, "l_shipdate")
