"""Draws and exact picks that depend on row keys only, never on partitioning or row order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.runtime import collect_bounded

_PREFIX = 4  # hex digits: 65,536 evenly filled buckets


def draw_hash(seed, *keys: Column) -> Column:
    """Hex digest of seed and keys; its text order is a reproducible shuffle of the rows."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def uniform(digest: Column, start: int = 1) -> Column:
    """Uniform draw in [0, 1) from eight hex digits of a digest."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def normal(digest: Column) -> Column:
    """Standard normal draw by the Box-Muller transform of two parts of a digest."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(digest, 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(digest, 9))


def strata_counts(df: DataFrame, stratum: str, most: int = 10_000) -> dict:
    """Rows per stratum; refuses columns of more than ``most`` values, which are not class labels."""
    rows = collect_bounded(df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")), most)
    if rows is None:
        raise ValueError(f"{stratum} has more than {most} values and cannot be stratified on")
    if any(r[0] is None for r in rows):
        raise ValueError(f"{stratum} holds nulls; drop them before stratifying")
    return {r[0]: r["n"] for r in sorted(rows, key=lambda r: r[0])}


def hash_cutoffs(df: DataFrame, stratum: str, digest: Column, wanted: dict) -> dict:
    """For each stratum, the digest of its n-th smallest row, for every n in ``wanted[stratum]``.

    Two light passes replace a sort of the table: rows are counted by digest prefix, and only the few
    buckets that contain a wanted rank are ordered. However hot a stratum is, a bucket holds
    1/65,536 of it.
    """
    spark = df.sparkSession
    kind = df.schema[stratum].dataType.simpleString()
    asked = [(s, int(n)) for s, ranks in wanted.items() for n in ranks if n > 0]
    if not asked:
        return {}
    hashed = df.select(F.col(stratum).alias("s"), digest.alias("h")).withColumn("p", F.substring("h", 1, _PREFIX))
    targets = spark.createDataFrame(sorted(set(asked)), f"s {kind}, t bigint")
    upto = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    buckets = hashed.groupBy("s", "p").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto))
    edges = (
        buckets.join(F.broadcast(targets), "s")
        .where((F.col("t") <= F.col("upto")) & (F.col("t") > F.col("upto") - F.col("n")))
        .select("s", "p", "t", (F.col("t") - F.col("upto") + F.col("n")).alias("within"))
        .collect()
    )
    edge_df = spark.createDataFrame(edges, f"s {kind}, p string, t bigint, within bigint")
    keys = F.broadcast(edge_df.select("s", "p").distinct())
    ranked = hashed.join(keys, ["s", "p"]).withColumn(
        "within", F.row_number().over(Window.partitionBy("s", "p").orderBy("h")).cast("bigint")
    )
    found = ranked.join(F.broadcast(edge_df), ["s", "p", "within"]).select("s", "t", "h").collect()
    return {(r["s"], r["t"]): r["h"] for r in found}
