"""Exact stratified splits and folds decided by key digests.

Each function finds a few cut-off digests (two light passes, see ``hash_cutoffs``) and then labels rows
with a plain comparison, so the table itself is never shuffled and the result does not depend on how it
is partitioned.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hashing import draw_hash, hash_cutoffs, strata_counts
from riskloom.runtime import attach_small


def share_out(counts: dict, total: int) -> dict:
    """Split ``total`` over the strata in proportion, largest remainders first, ties by stratum order."""
    n = sum(counts.values())
    exact = {s: total * c / n for s, c in counts.items()}
    out = {s: math.floor(x) for s, x in exact.items()}
    left = total - sum(out.values())
    for s in sorted(counts, key=lambda s: (out[s] - exact[s], s))[:left]:
        out[s] += 1
    return out


def _cut_count(df: DataFrame, stratum: str, digest: Column, cuts: dict, wanted: dict) -> Column:
    """How many of the stratum's cut-offs lie below the row's digest."""
    lists = {s: [cuts[(s, n)] for n in ranks if n > 0] for s, ranks in wanted.items()}
    zeros = {s: sum(1 for n in ranks if n <= 0) for s, ranks in wanted.items()}
    branch = None
    for s in wanted:
        below = F.lit(zeros[s])
        for h in lists[s]:
            below = below + (digest > F.lit(h)).cast("int")
        is_s = F.col(stratum) == F.lit(s)
        branch = F.when(is_s, below) if branch is None else branch.when(is_s, below)
    return branch


def _labelled(df: DataFrame, stratum: str, digest: Column, wanted: dict, name: str, cuts: dict | None = None) -> DataFrame:
    cuts = hash_cutoffs(df, stratum, digest, wanted) if cuts is None else cuts
    if len(wanted) <= 50:
        return df.withColumn(name, _cut_count(df, stratum, digest, cuts, wanted))
    kind = df.schema[stratum].dataType.simpleString()
    rows = [(s, [cuts[(s, n)] if n > 0 else "" for n in ranks]) for s, ranks in wanted.items()]
    table = df.sparkSession.createDataFrame(rows, f"{stratum} {kind}, _cuts array<string>")
    joined = attach_small(df, table, [stratum])
    return joined.withColumn(name, F.size(F.filter("_cuts", lambda c: c < digest))).drop("_cuts")


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 1, name: str = "split"
) -> DataFrame:
    """Add ``name`` = ``test`` or ``train``; the test rows are exactly ceil(n * test_size), shared out by class."""
    counts = strata_counts(df, label)
    total = math.ceil(sum(counts.values()) * test_size)
    wanted = {s: [n] for s, n in share_out(counts, total).items()}
    marked = _labelled(df, label, draw_hash(seed, F.col(key)), wanted, name)
    return marked.withColumn(name, F.when(F.col(name) == 0, F.lit("test")).otherwise(F.lit("train")))


def train_test(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    marked = stratified_split(df, label, key, test_size, seed, "_split")
    return marked.where("_split = 'train'").drop("_split"), marked.where("_split = 'test'").drop("_split")


def _fold_ends(counts: dict, k: int) -> dict:
    """Per class the ranks at which folds 0..k-2 end; sizes differ by at most one."""
    out = {}
    for s, n in counts.items():
        sizes = [n // k + (1 if f < n % k else 0) for f in range(k)]
        out[s] = [sum(sizes[: f + 1]) for f in range(k - 1)]
    return out


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 1, name: str = "fold") -> DataFrame:
    """Add fold numbers 0..k-1; within each class fold sizes differ by at most one."""
    return _labelled(df, label, draw_hash(seed, F.col(key)), _fold_ends(strata_counts(df, label), k), name)


def repeated_folds(df: DataFrame, label: str, key: str, k: int = 5, repeats: int = 3, seed: int = 1) -> DataFrame:
    """Add ``fold_0`` .. ``fold_{r-1}``: independent stratified foldings with seeds seed, seed + 1, ...

    Classes are counted once, and the cut-offs of all repeats are found side by side.
    """
    ends = _fold_ends(strata_counts(df, label), k)
    digests = [draw_hash(seed + r, F.col(key)) for r in range(repeats)]
    with ThreadPoolExecutor(max_workers=min(4, max(1, repeats))) as pool:
        cuts = list(pool.map(lambda h: hash_cutoffs(df, label, h, ends), digests))
    out = df
    for r in range(repeats):
        out = _labelled(out, label, digests[r], ends, f"fold_{r}", cuts[r])
    return out


def class_weights(df: DataFrame, label: str) -> dict:
    """Balanced weight n / (classes * n_class) of each class."""
    counts = strata_counts(df, label)
    n = sum(counts.values())
    return {s: n / (len(counts) * c) for s, c in counts.items()}


def with_class_weight(df: DataFrame, label: str, name: str = "weight", weights: dict | None = None) -> DataFrame:
    """Add the class weight as a column; weights are literals, so there is no join."""
    weights = weights or class_weights(df, label)
    column = None
    for s, w in weights.items():
        hit = F.col(label) == F.lit(s)
        column = F.when(hit, F.lit(w)) if column is None else column.when(hit, F.lit(w))
    return df.withColumn(name, column)


def positive_weight(df: DataFrame, label: str) -> float:
    """Negatives per positive, at least one positive assumed."""
    counts = strata_counts(df, label)
    positives = counts.get(1, 0)
    return (sum(counts.values()) - positives) / max(positives, 1)
