"""Queries for readers, writers, logs and audits; each writes a table of the data and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators.metrics import classification_metrics
from riskloom.plans import data
from riskloom.plans.catalog_metrics import CELLS, S
from riskloom.plans.catalog_profile import SPLIT_SQL
from riskloom.plans.registry import query
from riskloom.runtime import scratch_path
from riskloom.sources import tables

BY_FLAG = "SELECT l_returnflag, count(*) AS n, round(sum(CAST(l_quantity AS DOUBLE)), 2) AS quantity FROM lineitem GROUP BY l_returnflag"


def _by_flag(df):
    return df.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_quantity").cast("double")), 2).alias("quantity")
    )


@query("read_csv", BY_FLAG)
def read_csv(spark, d):
    path = scratch_path(spark, "landing") + ".csv"
    data.read(spark, d, "lineitem").write.option("header", True).csv(path)
    return _by_flag(tables.load_table(spark, path))


@query("read_parquet", BY_FLAG)
def read_parquet(spark, d):
    return _by_flag(tables.load_table(spark, f"{d}/lineitem.parquet"))


@query("land_csv_as_parquet", BY_FLAG)
def land_csv_as_parquet(spark, d):
    path = scratch_path(spark, "landing")
    data.read(spark, d, "lineitem").write.option("header", True).csv(f"{path}.csv")
    tables.land_csv(spark, f"{path}.csv", f"{path}.parquet")
    return _by_flag(tables.load_table(spark, f"{path}.parquet"))


@query("load_labelled", f"WITH a AS ({data.ACCOUNTS_SQL}) SELECT y, count(*) AS n, round(sum(amount), 2) AS amount FROM a GROUP BY y")
def load_labelled(spark, d):
    path = scratch_path(spark, "labelled")
    accounts = data.accounts(spark, d)
    accounts.write.option("header", True).csv(path)
    df = tables.load_labelled(spark, path, "y", accounts.schema)
    return df.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("table_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def table_shape(spark, d):
    return tables.shape(data.read(spark, d, "lineitem"))


@query("save_stage", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def save_stage(spark, d):
    path = scratch_path(spark, "stage")
    tables.save_stage(data.read(spark, d, "orders"), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("save_splits", f"WITH s AS ({SPLIT_SQL}) SELECT 'full' AS part, count(*) AS n, sum(y)::BIGINT AS positives FROM s UNION ALL SELECT split, count(*), sum(y) FROM s GROUP BY split")
def save_splits(spark, d):
    accounts = data.accounts(spark, d)
    paths = tables.save_splits(accounts, scratch_path(spark, "splits"), "y", "row_id", 0.2, 1)
    parts = [
        tables.load_labelled(spark, p, "y", accounts.schema).select(F.lit(name).alias("part"), "y") for name, p in paths.items()
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positives"))


@query("save_partitioned", f"WITH s AS ({SPLIT_SQL}) SELECT row_id FROM s WHERE split = 'test'")
def save_partitioned(spark, d):
    path = scratch_path(spark, "partitioned")
    tables.save_partitioned(data.accounts(spark, d), path, "y", "row_id", 0.2, 1)
    return spark.read.parquet(path).where("split = 'test'").select("row_id")


@query("append_rows", "SELECT count(*) * 2 AS n, round(sum(c_acctbal) * 2, 2) AS balance FROM customer")
def append_rows(spark, d):
    path = scratch_path(spark, "append")
    customers = data.read(spark, d, "customer")
    tables.append_rows(customers, path)
    tables.append_rows(customers.withColumn("c_nationkey", F.col("c_nationkey").cast("string")), path, like=customers)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("row_audit", "SELECT count(*) AS rows, 1000::BIGINT AS expected, count(*) = 1000 AS unchanged FROM orders")
def row_audit(spark, d):
    return tables.row_audit(data.read(spark, d, "orders"), 1000)


@query("metrics_report", f"{S} SELECT phase, {CELLS} FROM s GROUP BY phase")
def metrics_report(spark, d):
    path = scratch_path(spark, "report")
    tables.write_metrics(classification_metrics(data.scored(spark, d), ["phase"]), path)
    return spark.read.json(path).select("phase", "tn", "fp", "fn", "tp")


@query("data_fingerprint", "SELECT 'lineitem' AS source, 'l_linestatus' AS target, count(*) AS rows, 11 AS columns FROM lineitem")
def data_fingerprint(spark, d):
    return tables.fingerprint(data.read(spark, d, "lineitem"), "lineitem", "l_linestatus").drop("schema", "checksum")


@query("newest_records", "SELECT event_id, ts FROM events ORDER BY ts DESC LIMIT 10")
def newest_records(spark, d):
    return tables.newest(data.read(spark, d, "events").select("event_id", "ts"), "ts", 10)
