"""Run records and model versions as tables that stand retries and several writers.

Every run has a folder of its own, which a retry replaces. A version number is claimed by creating a file that must not exist yet, so
two writers never share one; the newest row per name counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS_SCHEMA = (
    "run_id string, parent_id string, run_name string, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>, ts timestamp"
)
VERSIONS_SCHEMA = "name string, version bigint, run_id string, alias string, stage string, tags map<string,string>, ts timestamp"


def new_run(
    name: str,
    params: Mapping | None = None,
    metrics: Mapping | None = None,
    tags: Mapping | None = None,
    parent_id: str | None = None,
    run_id: str | None = None,
) -> dict:
    """A run record; parameter and tag values are kept as text."""

    def text(v) -> str:
        return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) if isinstance(v, (list, dict)) else str(v)

    return {
        "run_id": run_id or uuid.uuid4().hex,
        "parent_id": parent_id,
        "run_name": name,
        "params": {k: text(v) for k, v in (params or {}).items()},
        "metrics": {k: float(v) for k, v in (metrics or {}).items() if v is not None},
        "tags": {k: text(v) for k, v in (tags or {}).items()},
    }


def runs_table(spark: SparkSession, records: Sequence[dict]) -> DataFrame:
    """Run records as a table; their number is that of fitted models, never of data rows."""
    fields = ("run_id", "parent_id", "run_name", "params", "metrics", "tags")
    rows = [tuple(r[f] for f in fields) for r in records]
    schema = RUNS_SCHEMA.rsplit(",", 1)[0]
    return spark.createDataFrame(rows, schema).withColumn("ts", F.current_timestamp())


def log_runs(spark: SparkSession, records: Sequence[dict], path: str) -> DataFrame:
    """Store run records and return them; a record replaces an earlier one of its run id and leaves all others alone."""
    table = runs_table(spark, records)
    if records:
        _by_folder(table, "run_id").parquet(path)
    return table


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All run records, also those of tables without a folder per run."""
    return spark.read.schema(RUNS_SCHEMA).parquet(path).select(*[f.split()[0] for f in RUNS_SCHEMA.split(", ")])


def phase_metrics(metrics: Mapping[str, float], phase: str) -> dict[str, float]:
    """Metric names prefixed by evaluation phase, the confusion counts left out."""
    skip = {"tn", "fp", "fn", "tp", "confusion_matrix", "phase"}
    return {f"{phase}_{k}": v for k, v in metrics.items() if k not in skip and v is not None}


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    where, files = _place(spark, path)
    return files.exists(where)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several callers exactly one gets True.

    Hadoop's local file system looks before it creates, so a local path is created exclusively by the operating system.
    """
    where, files = _place(spark, path)
    if files.getScheme() == "file":
        local = where.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return True
        except FileExistsError:
            return False
    try:
        files.create(where, False).close()
        return True
    except Exception:
        if files.exists(where):
            return False
        raise


def register_version(
    spark: SparkSession,
    path: str,
    name: str,
    run_id: str,
    tags: Mapping[str, str] | None = None,
    alias: str | None = "best",
    stage: str | None = "Staging",
) -> int:
    """Append a model version; numbers rise per name, and a number whose writer failed before its row stays unused."""
    last = None
    if _exists(spark, path):
        last = spark.read.schema(VERSIONS_SCHEMA).parquet(path).where(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    # A folder whose name begins with an underscore is not part of the table.
    claims = f"{path.rstrip('/')}/_claims/{hashlib.sha256(name.encode()).hexdigest()}"
    while not claim(spark, f"{claims}/{version}"):
        version += 1
    row = [(name, version, run_id, alias, stage, {k: str(v) for k, v in (tags or {}).items()})]
    table = spark.createDataFrame(row, VERSIONS_SCHEMA.rsplit(",", 1)[0]).withColumn("ts", F.current_timestamp())
    _by_folder(table, "name", "version").parquet(path)
    return version


def _by_folder(table: DataFrame, *columns: str):
    """A writer that replaces only the folders it writes, staged apart so that writers do not disturb each other."""
    return table.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns)


def latest_versions(versions: DataFrame) -> DataFrame:
    """Newest version per model name."""
    newest = Window.partitionBy("name").orderBy(F.desc("version"))
    return versions.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r")


def by_alias(versions: DataFrame, alias: str = "best") -> DataFrame:
    """The version an alias points to: the last one it was given to, per name."""
    return latest_versions(versions.where(F.col("alias") == alias))
