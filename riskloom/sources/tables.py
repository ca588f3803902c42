"""Reading and writing data tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.split import stratified_split


def suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def load_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, default: str | None = None
) -> DataFrame:
    """CSV (with header) or Parquet by suffix.

    Another suffix is an error unless ``default`` names the format to assume. Without a schema CSV columns
    stay text: a schema scan over a large file would read it twice, and the cleaner converts leniently anyway.
    """
    kind = suffix(path)
    if kind not in ("csv", "parquet"):
        if default is None:
            raise ValueError(f"unsupported format: {kind or path}")
        kind = default
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "parquet":
        return reader.parquet(path)
    return reader.option("header", True).option("mode", "PERMISSIVE").csv(path)


def load_labelled(spark: SparkSession, path: str, target: str, schema: T.StructType | None = None) -> DataFrame:
    """Training or hold-out table with the label as last column; CSV is assumed for unknown suffixes."""
    df = load_table(spark, path, schema, default="csv")
    if target not in df.columns:
        raise ValueError(f"label {target} is not a column of {path}")
    return df.select(*[c for c in df.columns if c != target], target)


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def land_csv(spark: SparkSession, source: str, destination: str) -> None:
    """Land a CSV file unchanged (all text) as Parquet."""
    load_table(spark, source).write.mode("overwrite").parquet(destination)


def save_stage(df: DataFrame, path: str) -> None:
    """Write the table of one stage; readers of the next stage prune columns and push filters."""
    df.write.mode("overwrite").parquet(path)


def save_splits(
    df: DataFrame, folder: str, label: str, key: str, test_size: float = 0.2, seed: int = 1, fmt: str = "csv"
) -> dict[str, str]:
    """Write the full table and its stratified train and test parts; returns the three paths.

    Split membership is a comparison with a few cut-off digests, so each write is one scan.
    """
    marked = stratified_split(df, label, key, test_size, seed, "_split")
    paths = {name: f"{folder.rstrip('/')}/{name}.{fmt}" for name in ("full", "train", "test")}

    def write(part: DataFrame, path: str) -> None:
        writer = part.write.mode("overwrite")
        writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)

    write(df, paths["full"])
    for name in ("train", "test"):
        write(marked.where(F.col("_split") == name).drop("_split"), paths[name])
    return paths


def save_partitioned(df: DataFrame, path: str, label: str, key: str, test_size: float = 0.2, seed: int = 1) -> None:
    """Both parts in one table partitioned by ``split``; reading one part prunes the other's files."""
    stratified_split(df, label, key, test_size, seed, "split").write.mode("overwrite").partitionBy("split").parquet(path)


def append_rows(rows: DataFrame, path: str, like: DataFrame | None = None) -> None:
    """Append records to a table; with ``like``, columns and types must match the existing table."""
    if like is not None:
        missing = set(like.columns) ^ set(rows.columns)
        if missing:
            raise ValueError(f"columns differ from the table: {sorted(missing)}")
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])
    rows.write.mode("append").parquet(path)


def row_audit(df: DataFrame, expected: int) -> DataFrame:
    """Row count beside the expected one."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(expected).cast("bigint").alias("expected"), (F.col("rows") == expected).alias("unchanged")
    )


def fingerprint(df: DataFrame, source: str, target: str) -> DataFrame:
    """Reference of a data set used by a run: source, target, rows, schema and an order-free checksum."""
    digest = F.xxhash64(*df.columns).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).cast("string").alias("checksum")).select(
        F.lit(source).alias("source"),
        F.lit(target).alias("target"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(df.schema.json()).alias("schema"),
        "checksum",
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write a metrics table as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def read_drift_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested drift summaries (one JSON document per line) as one row per document and column.

    The per-column results sit in whichever entry of ``metrics`` carries ``drift_by_columns``.
    """
    entry = "struct<column_type:string,stattest_name:string,stattest_threshold:double,drift_score:double,drift_detected:boolean>"
    schema = f"metrics array<struct<metric:string,result:struct<drift_by_columns:map<string,{entry}>>>>"
    docs = spark.read.schema(schema).json(path).withColumn("source", F.input_file_name())
    found = F.filter("metrics", lambda m: m["result"]["drift_by_columns"].isNotNull())
    return docs.select("source", F.explode(found[0]["result"]["drift_by_columns"]).alias("column", "d")).select(
        "source",
        "column",
        F.col("d.column_type").alias("column_type"),
        F.col("d.stattest_name").alias("stattest"),
        F.col("d.stattest_threshold").alias("threshold"),
        F.col("d.drift_score").alias("drift_score"),
        F.coalesce("d.drift_detected", F.lit(False)).alias("drift_detected"),
    )


def newest(df: DataFrame, by: str, limit: int = 1) -> DataFrame:
    """The newest rows of a log or report table; equal times are ordered by the rows' JSON text."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).limit(limit)
