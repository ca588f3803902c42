"""Session settings, scratch tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after it has been read to the driver and found to hold at most this many rows.
SMALL_ROWS = 100_000

_local_scratch: dict[str, str] = {}


def build_session(app: str = "riskloom", cpus: int | str = "*", **conf) -> SparkSession:
    """A local session with the settings the operators are written for.

    On a cluster the session comes from ``spark-submit``; only the adaptive settings below matter there.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Session settings that wide projections depend on; set only where the session still has the default.

    The JVM never compiles a method above 8,000 bytes, but Spark by default fuses operators into one method
    up to 65,535. A wide cleaning projection then runs interpreted, several times slower. With the lower
    limit Spark falls back to split projections, which are compiled.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a single-machine session may fall back to a temporary folder, because there every task sees it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="riskloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's scratch folder, grouped by application for easy expiry."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/riskloom-{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back.

    Unlike a cache it survives lost executors, and the file sizes give Catalyst real statistics.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_bounded(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """The rows of ``df`` if there are at most ``limit``, else ``None``; never reads more than that."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def attach_small(
    df: DataFrame, side: DataFrame, on: list[str], how: str = "left", limit: int = SMALL_ROWS
) -> DataFrame:
    """Join ``side`` onto ``df``; broadcast it only if it was counted as small, else leave the choice to AQE."""
    rows = collect_bounded(side, limit)
    if rows is not None:
        side = F.broadcast(df.sparkSession.createDataFrame(rows, side.schema))
    return df.join(side, on, how)
