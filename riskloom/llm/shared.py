"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
import sys
import tempfile
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.runtime import scratch_path


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True where crc32 of the id's decimal text is a multiple of 5; a null id is never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fresh(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` has that name (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def ensure_shared_folder(spark: SparkSession) -> None:
    """Keep ``spark.checkpoint.dir`` of the session; only a local session without it gets a temporary folder."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="riskloom-llm-"))


class Stored:
    """Tables written to the shared folder to cut lineage; ``drop`` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        ensure_shared_folder(spark)
        self.spark, self.name = spark, name

    def put(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str | None) -> None:
        if path:
            jvm = self.spark._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


_held: dict[Callable, tuple[tuple, object]] = {}


def _kept(build: Callable, *args):
    if build not in _held or _held[build][0] != args:
        _held.pop(build, None)  # the old one goes before the new one comes
        _held[build] = args, build(*args)
    return _held[build][1]


def per_process(build: Callable) -> Callable:
    """A picklable function that calls ``build`` once per Python worker and argument list, and keeps the last result.

    Workers are reused between tasks, so loading a vocabulary or a model is paid once, not once per partition. The store is this
    module's: a store of the function's own would travel to every task by value and be filled anew there. ``build`` must be found by name too.
    """
    return partial(_kept, build)


def give_back() -> None:
    """Return freed memory of a Python worker to the system: workers are kept between tasks, and what one stage freed would count beside the next."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        # The C library's own call; libraries without it keep what they hold.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def scattered(columns: list[Column]) -> Column:
    """A signed 64-bit digest of the columns, for sampling and seeded order."""
    return F.xxhash64(*columns)


def slices(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches cut into slices of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
