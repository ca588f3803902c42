"""Class resampling: SMOTE, NearMiss 1-3, edited neighbours, Tomek links and their combinations.

Every sampler takes and returns a table with a unique key, a binary label and ``array<double>`` features.
Random choices are digests of keys, so a sample does not depend on partitioning and survives lost tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import draw_hash, hash_cutoffs, strata_counts, uniform
from riskloom.functions.ordering import take_smallest
from riskloom.operators.neighbors import BLOCK_ROWS, mean_distance, nearest_neighbors
from riskloom.runtime import materialize


def _narrow(df: DataFrame, label: str, key: str, vec: str) -> DataFrame:
    return df.select(
        F.col(key).cast("string").alias(key), F.col(label).alias(label), F.col(vec).cast("array<double>").alias(vec)
    )


def minority_and_majority(df: DataFrame, label: str) -> tuple:
    """(minority class, its rows, majority class, its rows) of a two-class table."""
    counts = strata_counts(df, label)
    if len(counts) != 2:
        raise ValueError(f"two classes are needed, {label} has {len(counts)}")
    (a, n_a), (b, n_b) = counts.items()
    return (a, n_a, b, n_b) if n_a <= n_b else (b, n_b, a, n_a)


def smote_draws(df: DataFrame, key: str, extra: int, size: int, seed: int) -> DataFrame:
    """Add ``copy`` = 0.. for the synthetic rows to make from each row: equal shares, remainder by digest."""
    base, left = divmod(extra, size)
    digest = draw_hash(f"{seed}:share", F.col(key))
    times = F.lit(base)
    if left:
        ones = df.withColumn("_s", F.lit(0))
        cut = hash_cutoffs(ones, "_s", digest, {0: [left]})[(0, left)]
        times = times + (digest <= F.lit(cut)).cast("int")
    return df.withColumn("_times", times).where("_times > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1))
    ).drop("_times")


def smote(
    df: DataFrame,
    label: str,
    key: str,
    vec: str = "vec",
    k: int = 5,
    ratio: float = 1.0,
    seed: int = 1,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add synthetic minority rows until minority/majority reaches ``ratio`` (Chawla et al., 2002).

    A synthetic row lies on the segment from a minority row to one of its k nearest minority rows.
    """
    df = materialize(_narrow(df, label, key, vec), "smote")
    small, n_small, _, n_large = minority_and_majority(df, label)
    extra = int(n_large * ratio) - n_small
    if extra <= 0:
        return df
    if n_small < 2:
        raise ValueError("SMOTE needs at least two minority rows")
    few = df.where(F.col(label) == F.lit(small))
    k = min(k, n_small - 1)
    near = nearest_neighbors(few, few, k, key, vec, skip_self=True, block_rows=block_rows)
    draws = smote_draws(few, key, extra, n_small, seed)
    which = draw_hash(f"{seed}:which", F.col(key), F.col("copy"))
    gap = draw_hash(f"{seed}:gap", F.col(key), F.col("copy"))
    draws = draws.withColumn("rank", (F.floor(uniform(which) * k) + 1).cast("int")).withColumn("gap", uniform(gap))
    ends = few.select(F.col(key).alias("neighbor_id"), F.col(vec).alias("_to"))
    made = (
        draws.join(near.select(F.col("query_id").alias(key), "rank", "neighbor_id"), [key, "rank"])
        .join(ends, "neighbor_id")
        .select(
            F.concat(F.col(key), F.lit("~"), F.col("copy").cast("string")).alias(key),
            F.col(label),
            F.zip_with(vec, "_to", lambda a, b: a + F.col("gap") * (b - a)).alias(vec),
        )
    )
    return df.unionByName(made)


def near_miss(
    df: DataFrame,
    label: str,
    key: str,
    vec: str = "vec",
    version: int = 1,
    k: int = 3,
    k_first: int = 3,
    seed: int = 1,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Keep as many majority rows as there are minority rows (Mani and Zhang, 2003).

    Version 1 keeps the smallest mean distance to the k nearest minority rows, version 2 the smallest to
    the k farthest. Version 3 first keeps the ``k_first`` nearest majority rows of each minority row and of
    those the largest mean distance to the k nearest minority rows.
    """
    if version not in (1, 2, 3):
        raise ValueError(f"NearMiss version must be 1, 2 or 3, not {version}")
    df = materialize(_narrow(df, label, key, vec), "nearmiss")
    small, n_small, large, n_large = minority_and_majority(df, label)
    if n_small == n_large:
        return df
    few, many = df.where(F.col(label) == F.lit(small)), df.where(F.col(label) == F.lit(large))
    if version == 3:
        first = nearest_neighbors(few, many, k_first, key, vec, block_rows=block_rows)
        chosen = first.select(F.col("neighbor_id").alias(key)).distinct()
        many = materialize(many.join(chosen, key, "left_semi"), "nearmiss3")
    near = nearest_neighbors(many, few, k, key, vec, farthest=version == 2, block_rows=block_rows)
    scores = materialize(mean_distance(near).withColumnRenamed("query_id", key), "scores")
    kept = take_smallest(scores, n_small, "mean_distance", key, seed, largest=version == 3)
    return few.unionByName(many.join(kept.select(key), key, "left_semi"))


def edited_neighbors(
    df: DataFrame, label: str, key: str, vec: str = "vec", k: int = 3, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Drop every row that has a neighbour of another class among its k nearest (Wilson, 1972)."""
    df = _narrow(df, label, key, vec)
    near = nearest_neighbors(df, df, k, key, vec, skip_self=True, block_rows=block_rows)
    labels = df.select(F.col(key).alias("neighbor_id"), F.col(label).alias("_theirs"))
    own = df.select(F.col(key).alias("query_id"), F.col(label).alias("_mine"))
    odd = (
        near.join(labels, "neighbor_id")
        .join(own, "query_id")
        .where(F.col("_theirs") != F.col("_mine"))
        .select(F.col("query_id").alias(key))
        .distinct()
    )
    return df.join(odd, key, "left_anti")


def tomek_links(df: DataFrame, label: str, key: str, vec: str = "vec", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs (a, b) of different classes that are each other's nearest row, a < b (Tomek, 1976)."""
    df = _narrow(df, label, key, vec)
    near = nearest_neighbors(df, df, 1, key, vec, skip_self=True, block_rows=block_rows)
    one = materialize(near.select(F.col("query_id").alias("a"), F.col("neighbor_id").alias("b")), "links")
    back = one.select(F.col("a").alias("b"), F.col("b").alias("a"))
    labels = df.select(F.col(key).alias("_id"), F.col(label).alias("_y"))
    both = one.join(back, ["a", "b"]).where(F.col("a") < F.col("b"))
    left = labels.withColumnsRenamed({"_id": "a", "_y": "ya"})
    right = labels.withColumnsRenamed({"_id": "b", "_y": "yb"})
    return both.join(left, "a").join(right, "b").where(F.col("ya") != F.col("yb")).select("a", "b")


def drop_tomek(df: DataFrame, label: str, key: str, vec: str = "vec", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Drop both rows of every Tomek link."""
    df = _narrow(df, label, key, vec)
    links = tomek_links(df, label, key, vec, block_rows)
    gone = links.select(F.explode(F.array("a", "b")).alias(key))
    return df.join(gone, key, "left_anti")


def smote_enn(df: DataFrame, label: str, key: str, vec: str = "vec", seed: int = 1, **kw) -> DataFrame:
    """SMOTE, then edited neighbours over all rows (Batista et al., 2004)."""
    block_rows = kw.get("block_rows", BLOCK_ROWS)
    made = materialize(smote(df, label, key, vec, seed=seed, **kw), "smoteenn")
    return edited_neighbors(made, label, key, vec, block_rows=block_rows)


def smote_tomek(df: DataFrame, label: str, key: str, vec: str = "vec", seed: int = 1, **kw) -> DataFrame:
    """SMOTE, then removal of Tomek links."""
    block_rows = kw.get("block_rows", BLOCK_ROWS)
    made = materialize(smote(df, label, key, vec, seed=seed, **kw), "smotetomek")
    return drop_tomek(made, label, key, vec, block_rows=block_rows)


def no_sampling(df: DataFrame, label: str, key: str, vec: str = "vec", **_) -> DataFrame:
    return _narrow(df, label, key, vec)


SAMPLERS = {
    "SMOTE": smote,
    "NearMiss": near_miss,
    "SMOTEENN": smote_enn,
    "SMOTETomek": smote_tomek,
    "Passthrough": no_sampling,
}


def sampler_by_name(name: str | None):
    """The sampler function; None means no sampling, an unknown name is an error."""
    if name is None or name == "None":
        return no_sampling
    for known, fn in SAMPLERS.items():
        if known.lower() == name.strip().lower():
            return fn
    raise ValueError(f"unknown sampler {name!r}; known: {sorted(SAMPLERS)}")
