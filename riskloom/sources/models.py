"""Saving and loading fitted models with a description of what they expect."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.models import NeighborVoteModel


class FittedPipeline:
    """Preprocessing and model together: raw feature columns in, class and probability out."""

    def __init__(self, prep: PipelineModel, model):
        self.prep, self.model = prep, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prep.transform(df))


def save_model(fitted: FittedPipeline, path: str, example: DataFrame | None = None) -> None:
    """Write both parts; with ``example`` also its schema and first five rows."""
    fitted.prep.write().overwrite().save(f"{path}/prep")
    if isinstance(fitted.model, NeighborVoteModel):
        fitted.model.save_to(f"{path}/neighbors")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")
    if example is not None:
        save_signature(example, f"{path}/signature")


def save_signature(example: DataFrame, path: str) -> None:
    """Input columns, types and an example of five rows beside a model."""
    spark = example.sparkSession
    fields = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(example.dtypes)], "position int, name string, type string")
    fields.coalesce(1).write.mode("overwrite").json(f"{path}/columns")
    example.limit(5).coalesce(1).write.mode("overwrite").parquet(f"{path}/example")


def load_signature(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.json(f"{path}/columns").orderBy("position"), spark.read.parquet(f"{path}/example")


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at a path of any file system the session can reach."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def load_model(spark: SparkSession, path: str, fallback: str | None = None) -> FittedPipeline:
    """Load a saved model; ``fallback`` is tried when the first path does not exist."""
    if not exists(spark, path):
        if fallback is None or not exists(spark, fallback):
            raise FileNotFoundError(f"no model at {path}")
        path = fallback
    prep = PipelineModel.load(f"{path}/prep")
    if exists(spark, f"{path}/neighbors"):
        return FittedPipeline(prep, NeighborVoteModel.load_from(spark, f"{path}/neighbors"))
    return FittedPipeline(prep, PipelineModel.load(f"{path}/model") if _is_pipeline(spark, path) else _load_single(spark, path))


def _class_name(spark: SparkSession, path: str) -> str:
    return spark.read.json(f"{path}/model/metadata").first()["class"]


def _is_pipeline(spark: SparkSession, path: str) -> bool:
    return _class_name(spark, path).endswith("PipelineModel")


def _load_single(spark: SparkSession, path: str):
    import pyspark.ml.classification as c

    return getattr(c, _class_name(spark, path).rsplit(".", 1)[-1]).load(f"{path}/model")
