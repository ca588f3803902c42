"""Input tables of the registered queries, derived from the given tables by plain expressions.

The expression texts are valid in Spark SQL and in ANSI SQL, so a query and its SQL twin start from the same
rows. Whole tables are used throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.config import CleanSpec, FeatureSpec


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _sql(columns: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {table}"


def _frame(spark, folder, table, columns) -> DataFrame:
    return read(spark, folder, table).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


# Dirty applications, all text, one junk column; made from line items.
RAW = {
    "c1": "CASE WHEN l_partkey % 17 = 0 THEN ' NaN ' WHEN l_partkey % 29 = 0 THEN '?' WHEN l_partkey % 31 = 0 THEN '' "
    "ELSE CAST(l_extendedprice AS STRING) END",
    "c2": "CASE WHEN l_suppkey % 13 = 0 THEN 'invalid' ELSE CAST(l_quantity AS STRING) END",
    "c3": "CAST(l_discount AS STRING)",
    "c4": "CASE WHEN l_partkey % 19 = 0 THEN ' N/A ' WHEN l_partkey % 23 = 0 THEN '  ' || l_returnflag || ' ' "
    "WHEN l_orderkey % 97 = 0 THEN 'odd' || CAST(l_orderkey AS STRING) ELSE l_returnflag END",
    "c5": "CASE WHEN l_partkey % 37 = 0 THEN 'Unknown' ELSE CAST(l_linenumber AS STRING) END",
    "c6": "CASE WHEN l_orderkey % 41 = 0 THEN 'error' WHEN l_linestatus = 'F' THEN '1.0' ELSE '0' END",
    "c7": "'x'",
}
RAW_NAMES = ("amount", "term", "rate", "purpose", "residence", "target", "mixed")
RAW_SQL = _sql(dict(zip(RAW_NAMES, RAW.values())), "lineitem")
RAW_SPEC = CleanSpec(
    rename=RAW_NAMES,
    target="target",
    drop=("mixed",),
    caps={"term": 45.0, "amount": 90000.0},
    features=FeatureSpec(numeric=("amount", "term", "rate"), nominal=("purpose",), ordinal=("residence",)),
)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, "lineitem", RAW)


def raw_named(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, "lineitem", dict(zip(RAW_NAMES, RAW.values())))


# Accounts with a learnable, imbalanced label; made from orders, keyed by o_orderkey.
ACCOUNTS = {
    "row_id": "o_orderkey",
    "amount": "CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END",
    "term": "CAST(o_custkey % 73 AS DOUBLE)",
    "priority": "CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END",
    "status": "o_orderstatus",
    "grade": "CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_custkey % 5 + 1 AS DOUBLE) END",
    "y": "CASE WHEN (o_totalprice / 500000e0 + (o_custkey % 73) / 73e0 > 1.45e0) <> (o_orderkey % 11 = 0) THEN 1 ELSE 0 END",
}
ACCOUNTS_SQL = _sql(ACCOUNTS, "orders")
ACCOUNT_SPEC = FeatureSpec(numeric=("amount", "term"), nominal=("priority", "status"), ordinal=("grade",))


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, "orders", ACCOUNTS)


# A scored table with three phases and five folds; made from events.
SCORED = {
    "row_id": "event_id",
    "phase": "CASE WHEN event_id % 10 < 6 THEN 'train' WHEN event_id % 10 < 8 THEN 'val' ELSE 'test' END",
    "fold": "CAST(event_id % 5 AS INT)",
    "y_true": "CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END",
    "y_pred": "CASE WHEN value >= 50 THEN 1 ELSE 0 END",
    "y_prob": "value / 500e0",
}
SCORED_SQL = _sql(SCORED, "events")


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, "events", SCORED)


# Two halves of the events for drift tests.
DRIFT = {
    "event_id": "event_id",
    "value": "value",
    "event_type": "event_type",
    "user_id": "user_id",
    "quarter": "CAST(event_id % 4 AS INT)",
    "parity": "CAST(event_id % 2 AS INT)",
    "late": "CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' THEN 1 ELSE 0 END",
}
DRIFT_SQL = _sql(DRIFT, "events")
DRIFT_COLUMNS = ("value", "event_type", "user_id", "quarter", "parity")


def drift_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    df = _frame(spark, folder, "events", DRIFT)
    return df.where("late = 0").select(*DRIFT_COLUMNS), df.where("late = 1").select(*DRIFT_COLUMNS)


# Labelled points for the samplers: label 0 of the embeddings is the minority class.
POINTS = {"id": "vec_id", "y": "CASE WHEN label = 0 THEN 1 ELSE 0 END", "vec": "CAST(embedding AS {doubles})"}
POINTS_SQL = _sql(POINTS, "embeddings").replace("{doubles}", "DOUBLE[]")


def points(spark: SparkSession, folder: str) -> DataFrame:
    columns = {n: e.replace("{doubles}", "ARRAY<DOUBLE>") for n, e in POINTS.items()}
    return _frame(spark, folder, "embeddings", columns)


# Scoring requests with some contract violations; made from orders.
REQUESTS = {
    "row_id": "o_orderkey",
    "status": "CAST(o_orderkey % 4 + 1 AS DOUBLE)",
    "duration": "CAST(o_orderkey % 72 + 2 AS DOUBLE)",
    "credit_history": "CAST(o_custkey % 5 AS DOUBLE)",
    "purpose": "CAST(o_custkey % 12 AS DOUBLE)",
    "amount": "CASE WHEN o_orderkey % 50 = 0 THEN -o_totalprice ELSE o_totalprice END",
    "savings": "CAST(o_orderkey % 5 + 1 AS DOUBLE)",
    "employment_duration": "CAST(o_custkey % 5 + 1 AS DOUBLE)",
    "installment_rate": "CAST(o_orderkey % 4 + 1 AS DOUBLE)",
    "personal_status_sex": "CAST(o_custkey % 5 + 1 AS DOUBLE)",
    "other_debtors": "CAST(o_orderkey % 3 + 1 AS DOUBLE)",
    "present_residence": "CAST(o_custkey % 4 + 1 AS DOUBLE)",
    "property": "CAST(o_orderkey % 4 + 1 AS DOUBLE)",
    "age": "CAST(o_custkey % 60 + 17 AS DOUBLE)",
    "other_installment_plans": "CAST(o_orderkey % 3 + 1 AS DOUBLE)",
    "housing": "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_custkey % 3 + 1 AS DOUBLE) END",
    "number_credits": "CAST(o_orderkey % 4 + 1 AS DOUBLE)",
    "job": "CAST(o_custkey % 4 + 1 AS DOUBLE)",
    "people_liable": "CAST(o_orderkey % 2 + 1 AS DOUBLE)",
    "telephone": "CAST(o_custkey % 2 + 1 AS DOUBLE)",
    "foreign_worker": "CAST(o_orderkey % 2 + 1 AS DOUBLE)",
}
REQUESTS_SQL = _sql(REQUESTS, "orders")


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, "orders", REQUESTS)


# Search candidates: one child run per order under one of seven parents; metrics are arithmetic on the order.
RUNS = {
    "run_id": "'c' || CAST(o_orderkey AS STRING)",
    "candidate": "CAST(o_orderkey AS BIGINT)",
    "parent_id": "'p' || CAST(o_custkey % 7 AS STRING)",
    "parent_name": "CASE o_custkey % 7 WHEN 0 THEN 'RandomForest + SMOTE v2__GRID' WHEN 1 THEN 'DecisionTree + SMOTE v2__GRID' "
    "WHEN 2 THEN 'MLP + SMOTE v2__GRID' WHEN 3 THEN 'SVC + SMOTE v2__GRID' WHEN 4 THEN 'KNN + SMOTE v2__GRID' "
    "WHEN 5 THEN 'LogReg + SMOTE v2__GRID' ELSE 'Other trial__GRID' END",
    "mean_test_roc_auc": "CASE WHEN o_custkey % 7 = 4 THEN 0.60e0 ELSE 0.62e0 + (o_orderkey % 211) / 1000e0 END",
    "mean_train_roc_auc": "0.64e0 + (o_orderkey % 233) / 1000e0",
    "mean_test_f1": "0.40e0 + (o_custkey % 199) / 1000e0",
    "mean_train_f1": "0.42e0 + (o_custkey % 223) / 1000e0",
    "mean_test_precision": "0.35e0 + (o_orderkey % 97) / 200e0",
    "mean_test_recall": "0.30e0 + (o_custkey % 89) / 150e0",
    "depth": "CAST(o_orderkey % 9 AS STRING)",
    "c": "CAST(o_custkey % 4 AS STRING)",
}
RUNS_SQL = _sql(RUNS, "orders")
RUN_NAMES = (
    "RandomForest + SMOTE v2__GRID",
    "DecisionTree + SMOTE v2__GRID",
    "MLP + SMOTE v2__GRID",
    "SVC + SMOTE v2__GRID",
    "KNN + SMOTE v2__GRID",
    "LogReg + SMOTE v2__GRID",
)


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    return _frame(spark, folder, "orders", RUNS)


def run_records(spark: SparkSession, folder: str) -> DataFrame:
    """The candidates as run records: parents and children with parameter, metric and tag maps."""
    from pyspark.sql import functions as F

    from riskloom.operators.select import with_gates

    flat = with_gates(candidates(spark, folder))
    children = flat.select(
        "run_id",
        "parent_id",
        F.concat("parent_name", F.lit("__cand"), "candidate").alias("run_name"),
        F.create_map(F.lit("model__max_depth"), "depth", F.lit("model__C"), "c", F.lit("cand::x"), F.lit("1")).alias("params"),
        F.create_map(
            F.lit("cv_cand_test_roc_auc"), "mean_test_roc_auc",
            F.lit("cv_cand_train_roc_auc"), "mean_train_roc_auc",
            F.lit("cv_cand_test_f1"), "mean_test_f1",
            F.lit("cv_cand_train_f1"), "mean_train_f1",
            F.lit("cv_cand_test_precision"), "mean_test_precision",
            F.lit("cv_cand_test_recall"), "mean_test_recall",
        ).alias("metrics"),
        F.create_map(F.lit("gate_passes"), F.initcap(F.col("gate_passes").cast("string"))).alias("tags"),
    )
    parents = flat.groupBy("parent_id", "parent_name").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("parent_id").alias("run_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("parent_name").alias("run_name"),
        F.create_map(F.lit("children"), F.col("n").cast("string")).alias("params"),
        F.create_map(F.lit("n"), F.col("n").cast("double")).alias("metrics"),
        F.create_map(F.lit("stage"), F.lit("grid-search")).alias("tags"),
    )
    return children.unionByName(parents)
