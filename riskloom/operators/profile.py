"""Profiles of whole tables: every operator is one or two aggregations however many columns there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.ordering import exact_quantiles, long_form
from riskloom.operators.clean import value_counts_long
from riskloom.runtime import collect_bounded


def _unpivot_row(row: DataFrame, columns: Sequence[str], stats: dict[str, str]) -> DataFrame:
    """Turn a one-row aggregate with fields ``<stat>_<i>`` into one row per column."""
    parts = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}_{i}").cast(t).alias(s) for s, t in stats.items()])
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*parts)))


def _nan_as_null(df: DataFrame) -> DataFrame:
    """``df`` with NaN as null in its floating-point columns."""
    return df.select(*[F.nanvl(F.col(f"`{n}`"), F.lit(None).cast(t)).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes])


def info(df: DataFrame) -> DataFrame:
    """Type and non-null count of each column; NaN counts as null."""
    df = _nan_as_null(df)
    aggs = [F.count(c).alias(f"non_null_{i}") for i, c in enumerate(df.columns)]
    types = [F.lit(t).alias(f"type_{i}") for i, (_, t) in enumerate(df.dtypes)]
    return _unpivot_row(df.agg(*aggs).select("*", *types), df.columns, {"type": "string", "non_null": "bigint"})


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min, exact quartiles, max; one row per column, NaN as missing."""
    columns = list(columns)
    df = _nan_as_null(df.select(*columns))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    row = df.agg(*aggs)
    for i, c in enumerate(columns):
        for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            row = row.withColumn(f"{n}_{i}", F.lit(quartiles[(c, q)]).cast("double"))
    stats = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
    return _unpivot_row(row, columns, {s: "bigint" if s == "count" else "double" for s in stats})


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq per column; the smallest value wins a tie."""
    counts = value_counts_long(df, columns).where(F.col("value").isNotNull())
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def n_unique(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column; ``approx`` trades exactness for no shuffle of values."""
    if approx:
        aggs = [F.approx_count_distinct(c).alias(f"n_unique_{i}") for i, c in enumerate(columns)]
        return _unpivot_row(df.agg(*aggs), columns, {"n_unique": "bigint"}).orderBy(F.desc("n_unique"), "column")
    counts = value_counts_long(df, columns)
    return (
        counts.groupBy("column").agg(F.count("value").alias("n_unique")).orderBy(F.desc("n_unique"), "column")
    )


def value_counts(df: DataFrame, columns: Sequence[str], by: str = "value") -> DataFrame:
    """Counts of every value of every column, null as a value of its own."""
    order = [F.col("value").asc_nulls_last()] if by == "value" else [F.desc("n"), F.col("value").asc_nulls_last()]
    return value_counts_long(df, columns).orderBy("column", *order)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of each column; NaN is missing."""
    df = _nan_as_null(df)
    aggs = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]
    return _unpivot_row(df.agg(*aggs), df.columns, {"nulls": "bigint"})


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Rows per class and share of each class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def positive_share(df: DataFrame, target: str) -> DataFrame:
    y = F.col(target).cast("double")
    return df.agg(
        F.count(y).alias("rows"),
        F.sum(y).cast("bigint").alias("positives"),
        (F.avg(y) * 100).alias("positive_pct"),
        ((F.lit(1.0) - F.avg(y)) * 100).alias("negative_pct"),
    )


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present; one aggregation."""
    columns = list(columns)
    aggs, parts = [], []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if i <= j:
                both = F.col(a).isNotNull() & F.col(b).isNotNull()
                x = F.when(both, F.col(a).cast("double"))
                y = F.when(both, F.col(b).cast("double"))
                aggs.append(F.corr(x, y).alias(f"r_{i}_{j}"))
            lo, hi = min(i, j), max(i, j)
            parts.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r_{lo}_{hi}").alias("r")))
    long = df.agg(*aggs).select(F.inline(F.array(*parts)))
    return long.withColumn("r", F.when(~F.isnan("r"), F.col("r")))


def box_summary(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (outermost values within 1.5 IQR) and number of outliers per column."""
    columns = list(columns)
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs, fixed = [], {}
    for i, c in enumerate(columns):
        q1, q2, q3 = (q[(c, p)] for p in (0.25, 0.5, 0.75))
        x = F.col(c).cast("double")
        if q1 is None:
            inside = F.lit(False)
        else:
            inside = (x >= F.lit(q1 - reach * (q3 - q1))) & (x <= F.lit(q3 + reach * (q3 - q1)))
        aggs += [
            F.min(F.when(inside, x)).alias(f"whisker_low_{i}"),
            F.max(F.when(inside, x)).alias(f"whisker_high_{i}"),
            F.count(F.when(~inside, x)).alias(f"outliers_{i}"),
        ]
        fixed.update({f"q1_{i}": q1, f"median_{i}": q2, f"q3_{i}": q3})
    row = df.agg(*aggs)
    for name, value in fixed.items():
        row = row.withColumn(name, F.lit(value).cast("double"))
    stats = ("q1", "median", "q3", "whisker_low", "whisker_high", "outliers")
    return _unpivot_row(row, columns, {s: "bigint" if s == "outliers" else "double" for s in stats})


def outlier_points(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """The rows outside the whiskers of a column."""
    q = exact_quantiles(df, [column], [0.25, 0.75])
    q1, q3 = q[(column, 0.25)], q[(column, 0.75)]
    if q1 is None:
        return df.limit(0)
    x = F.col(column).cast("double")
    return df.where((x < F.lit(q1 - reach * (q3 - q1))) | (x > F.lit(q3 + reach * (q3 - q1))))


def ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest value per column, on the driver."""
    row = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(columns)}


def bin_index(c, lo: float, hi: float, bins: int):
    """0-based equal-width bin; the last bin is closed on the right, a constant column is one bin."""
    x = c.cast("double")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(0))
    raw = F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)).cast("int")
    return F.least(raw, F.lit(bins - 1))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width histogram of each column; empty bins are listed with 0."""
    columns = list(columns)
    span = ranges(df, columns)
    used = [c for c in columns if span[c][0] is not None]
    parts = [F.struct(F.lit(c).alias("column"), bin_index(F.col(c), *span[c], bins).alias("bin")) for c in used]
    counted = (
        df.select(F.inline(F.array(*parts))).where(F.col("bin").isNotNull())
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = [
        (c, b, lo + b * (hi - lo) / bins, lo + (b + 1) * (hi - lo) / bins)
        for c in used
        for lo, hi in [span[c]]
        for b in range(bins)
    ]
    frame = df.sparkSession.createDataFrame(grid, "column string, bin int, lower double, upper double")
    return frame.join(counted, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def density_curve(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density on a grid (Scott's bandwidth).

    Every row adds its kernel at each grid point to one sum per point, all within one aggregation. So the data is neither
    multiplied by the grid nor shuffled, at the price of ``points`` exponentials a row.
    """
    x = F.col(column).cast("double")
    stat = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("s"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    schema = "point int, x double, density double"
    if not stat["n"] or not stat["s"]:
        return df.sparkSession.createDataFrame([], schema)
    n, width = stat["n"], stat["s"] * stat["n"] ** (-0.2)
    step = (stat["hi"] - stat["lo"]) / (points - 1)
    grid = [stat["lo"] + i * step for i in range(points)]
    norm = n * width * (2.0 * 3.141592653589793) ** 0.5
    sums = [
        (F.sum(F.exp(F.lit(-0.5) * F.pow((x - F.lit(g)) / F.lit(width), F.lit(2.0)))) / F.lit(norm)).alias(f"d_{i}")
        for i, g in enumerate(grid)
    ]
    parts = [
        F.struct(F.lit(i).alias("point"), F.lit(g).alias("x"), F.col(f"d_{i}").alias("density"))
        for i, g in enumerate(grid)
    ]
    return df.agg(*sums).select(F.inline(F.array(*parts)))


def ordered_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of a coded column by numeric code, largest code first; texts that are no number are left out."""
    from riskloom.functions.text import to_num

    code = to_num(F.col(column))
    counts = df.select(code.alias("code")).where(F.col("code").isNotNull()).groupBy("code")
    return counts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("code"))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """First rows turned on their side: one line per column, one field per row."""
    head = df.limit(rows).collect()
    table = [(c, *[None if r[c] is None else str(r[c]) for r in head]) for c in df.columns]
    fields = ", ".join(["column string", *[f"row_{i} string" for i in range(len(head))]])
    return df.sparkSession.createDataFrame(table, fields)


def frequency_of_value(df: DataFrame, column: str, name: str = "frequency") -> DataFrame:
    """Add how often each row's value occurs; null counts as a value.

    The counts are joined back instead of windowed, so a hot value is never gathered in one task.
    """
    counts = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias(name))
    from riskloom.runtime import SMALL_ROWS

    rows = collect_bounded(counts, SMALL_ROWS)
    if rows is not None:
        counts = F.broadcast(df.sparkSession.createDataFrame(rows, counts.schema))
    return df.join(counts, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")
