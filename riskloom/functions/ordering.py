"""Ordered work without a single-task sort: running totals, exact ranks, quantiles and top-n picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.hashing import draw_hash, hash_cutoffs
from riskloom.functions.text import nan_to_null
from riskloom.runtime import attach_small, materialize

# Ranges per group: at least this many, more for large groups, found in two steps of this width.
BUCKETS = 64
MAX_BUCKETS = BUCKETS * BUCKETS
ROWS_PER_BUCKET = 1_000_000
# Groups up to this many grouped rows are ordered by one task each; larger ones are cut into ranges.
ONE_TASK_ROWS = 1_000_000


def _bounds(df: DataFrame, groups: list[str], key: str, buckets: int) -> DataFrame:
    """Approximate, evenly filled range limits of ``key`` per group (any limits give exact results)."""
    if isinstance(df.schema[key].dataType, T.StringType):
        order = Window.partitionBy(*groups).orderBy(draw_hash("bounds", F.col(key)))
        sample = df.select(*groups, key).withColumn("_r", F.row_number().over(order)).where(F.col("_r") < 16 * buckets)
        limits = F.array_sort(F.collect_list(key))
        picks = F.array(*[F.try_element_at(limits, F.lit(16 * i)) for i in range(1, buckets)])
        limits = sample.groupBy(*groups).agg(F.filter(picks, lambda x: x.isNotNull()).alias("_bounds"))
    else:
        shares = [i / buckets for i in range(1, buckets)]
        sketch = F.percentile_approx(key, shares, max(2000, 4 * buckets))
        limits = df.groupBy(*groups).agg(F.array_distinct(sketch).alias("_bounds"))
    return limits.withColumn("_coarse", F.filter("_bounds", lambda _, i: i % BUCKETS == BUCKETS - 1))


def _bucket(key: str):
    """Number of range limits below the key, found in a coarse and a fine step."""
    coarse = F.size(F.filter("_coarse", lambda b: b < F.col(key))) * BUCKETS
    return coarse + F.size(F.filter(F.slice("_bounds", coarse + 1, BUCKETS), lambda b: b < F.col(key)))


def running_totals(
    df: DataFrame, groups: list[str], key: str, sums: list[str], buckets: int | None = None, stored: bool = False
) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` in order of ``key`` within each group.

    ``df`` must hold one row per (groups, key), as left by a ``groupBy``. Each group is cut into ranges of
    similar size, the sums before a range come from the tiny table of range totals, so that no task
    orders a whole group.
    """
    base = df if stored else materialize(df, "running")
    own = groups or ["_all"]
    if not groups:
        base = base.withColumn("_all", F.lit(0))
    sizes = base.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if sizes <= ONE_TASK_ROWS:
        plain = Window.partitionBy(*own).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
        return base.withColumns({f"cum_{c}": F.sum(c).over(plain) for c in sums}).drop("_all")
    buckets = buckets or min(MAX_BUCKETS, max(BUCKETS, sizes // ROWS_PER_BUCKET))
    cut = attach_small(base, _bounds(base, own, key, buckets), own)
    cut = cut.withColumn("_bucket", _bucket(key)).drop("_bounds", "_coarse")
    before = Window.partitionBy(*own).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*own, "_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = totals.select(*own, "_bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inside = Window.partitionBy(*own, "_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = attach_small(cut, offsets, own + ["_bucket"])
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.sum(c).over(inside) + F.col(f"_o_{c}"))
    return out.drop("_bucket", "_all", *[f"_o_{c}" for c in sums])


def row_numbers(df: DataFrame, key: str, name: str = "row_number", buckets: int | None = None) -> DataFrame:
    """Global 1-based position in order of a unique ``key``."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_totals(ones, [], key, ["_one"], buckets, stored=True).withColumnRenamed("cum__one", name).drop("_one")


def take_smallest(df: DataFrame, n: int, value: str, key: str, seed=0, largest: bool = False) -> DataFrame:
    """Exactly the ``n`` rows with the smallest ``value``; equal values are split in digest order of ``key``.

    ``n`` may be as large as the table: the result is a filter, not a sort to one task.
    """
    spark = df.sparkSession
    if n <= 0:
        return df.limit(0)
    ordered = F.col(value) if not largest else -F.col(value)
    src = df.withColumn("_v", ordered)
    counts = src.groupBy("_v").agg(F.count(F.lit(1)).alias("n"))
    edge = (
        running_totals(counts, [], "_v", ["n"])
        .where((F.col("cum_n") >= n) & (F.col("cum_n") - F.col("n") < n))
        .select("_v", "n", (F.lit(n) - F.col("cum_n") + F.col("n")).alias("need"))
        .collect()
    )
    if not edge:
        return src.drop("_v")
    limit, size, need = edge[0]["_v"], edge[0]["n"], edge[0]["need"]
    if need == size:
        return src.where(F.col("_v") <= F.lit(limit)).drop("_v")
    digest = draw_hash(seed, F.col(key))
    ties = src.where(F.col("_v") == F.lit(limit)).withColumn("_s", F.lit(0))
    cut = hash_cutoffs(ties, "_s", digest, {0: [need]})[(0, need)]
    return src.where((F.col("_v") < F.lit(limit)) | ((F.col("_v") == F.lit(limit)) & (digest <= F.lit(cut)))).drop("_v")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[tuple[str, float], float | None]:
    """Exact linearly interpolated quantiles of numeric columns, nulls and NaN skipped.

    A sketch brackets each wanted rank in a first pass; a second pass groups only the values inside the
    brackets. A bracket that misses its rank is widened to everything.
    """
    slack = 0.005
    lo_hi = [p for q in probs for p in (max(q - slack, 0.0), min(q + slack, 1.0))]
    src = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    sketch = src.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, lo_hi, 2000).alias(f"s_{i}") for i, c in enumerate(columns)],
    ).first()
    out: dict[tuple[str, float], float | None] = {}
    todo = []
    for i, c in enumerate(columns):
        n = sketch[f"n_{i}"]
        for j, q in enumerate(probs):
            if n == 0:
                out[(c, q)] = None
                continue
            lo, hi = sketch[f"s_{i}"][2 * j], sketch[f"s_{i}"][2 * j + 1]
            todo.append((c, q, q * (n - 1), lo, hi))
    while todo:
        got = _bracketed(src, columns, todo)
        missed = []
        for k, (c, q, pos, _, _) in enumerate(todo):
            part = pos - int(pos)
            first, second = got.get((k, 0)), got.get((k, 1))
            if first is None or (part > 0 and second is None):
                if todo[k][3] == float("-inf") and todo[k][4] == float("inf"):
                    raise RuntimeError(f"rank {pos} of column {c} was not found among all its values")
                missed.append((c, q, pos, float("-inf"), float("inf")))
            else:
                out[(c, q)] = first if part == 0 else first + part * (second - first)
        todo = missed
    return out


def _bracketed(src: DataFrame, columns: list[str], todo: list) -> dict[tuple[int, int], float]:
    """Values at ranks floor(pos) and floor(pos) + 1 of each (column, share, pos, low, high) in ``todo``.

    One pass groups the values inside any bracket one by one and all other values by the zone between
    brackets they fall into, so both the ranks below a bracket and the values in it come out of it.
    """
    spark = src.sparkSession
    parts, targets = [], []
    for i, c in enumerate(columns):
        mine = sorted((t[3], t[4], k) for k, t in enumerate(todo) if t[0] == c)
        if not mine:
            continue
        x = F.col(c)
        inside, zone = F.lit(False), F.lit(0)
        for place, (lo, hi, k) in enumerate(mine):
            inside = inside | ((x >= F.lit(lo)) & (x <= F.lit(hi)))
            zone = zone + (x >= F.lit(lo)).cast("int")
            targets.append((i, k, place, lo, hi))
        cells = [F.lit(i).alias("c"), F.when(inside, F.lit(-1)).otherwise(zone).alias("zone"), F.when(inside, x).alias("v")]
        parts.append(F.struct(*cells))
    cells = src.select(F.inline(F.array(*parts))).where(F.col("zone").isNotNull())
    grouped = materialize(cells.groupBy("c", "zone", "v").agg(F.count(F.lit(1)).alias("n")), "brackets")
    asked = F.broadcast(spark.createDataFrame(targets, "c int, k int, place int, lo double, hi double"))
    paired = grouped.join(asked, "c")
    under = F.when(F.col("v").isNull(), F.col("zone") <= F.col("place")).otherwise(F.col("v") < F.col("lo"))
    below = {r["k"]: r["b"] for r in paired.groupBy("k").agg(F.sum(F.when(under, F.col("n")).otherwise(0)).alias("b")).collect()}
    held = paired.where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).select("k", "v", "n")
    ranked = running_totals(held, ["k"], "v", ["n"], stored=True)
    wanted = spark.createDataFrame(
        [(k, side, int(t[2]) + side - below.get(k, 0)) for k, t in enumerate(todo) for side in (0, 1)],
        "k int, side int, at bigint",
    )
    hits = ranked.join(F.broadcast(wanted), "k").where(
        (F.col("at") < F.col("cum_n")) & (F.col("at") >= F.col("cum_n") - F.col("n"))
    )
    return {(r["k"], r["side"]): r["v"] for r in hits.select("k", "side", "v").collect()}


def ordered_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null values of a column with their 0-based position in sorted order."""
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).cast("bigint").alias("one"))
    ranks = running_totals(values, [], column, ["one"])
    return ranks.select(column, (F.col("cum_one") - 1).alias(name))


def long_form(df: DataFrame, columns: list[str], name: str = "column", value: str = "value", kind: str = "string", keep: list[str] | None = None) -> DataFrame:
    """One row per (row, column): the shape in which all columns share one shuffle."""
    keep = keep or []
    parts: list[Column] = [F.struct(F.lit(c).alias(name), F.col(c).cast(kind).alias(value)) for c in columns]
    return df.select(*keep, F.inline(F.array(*parts)))
