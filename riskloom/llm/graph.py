"""Connected components of an edge table as a few Spark joins, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.shared import Stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``a``, ``b``: long), component = smallest node reachable.

    Alternates two star steps: each node hands its smallest neighbour first to its larger neighbours, then to its
    smaller ones. The edge set shrinks to one star per component in a number of rounds that grows with the logarithm
    of the longest path. Minima are aggregated before the shuffle and rows of a hub are joined, never gathered, so a hub
    with a third of all edges is split by Spark's skewed-join handling. Each round is a table in the shared folder.
    Loops, repeated edges and nulls are ignored.
    """
    spark = edges.sparkSession
    stored = Stored(spark, "components")
    clean = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, path = stored.put(clean)
    mark = _mark(current)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        # Large star: every node's neighbours, both ways; larger neighbours go to the smallest one.
        both = current.select("u", "v").union(current.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large, large_path = stored.put(large)
        # Small star: the smaller neighbours of a node, and the node itself, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").union(least.select("u", F.col("m").alias("v"))).distinct()
        following, new_path = stored.put(small)
        stored.drop(path)
        stored.drop(large_path)
        current, path = following, new_path
        new_mark = _mark(current)
        if new_mark == mark:
            break
        mark = new_mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0
