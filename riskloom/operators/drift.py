"""Drift injection, per-column drift tests and the drift monitor."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.hashing import draw_hash, normal, uniform
from riskloom.functions.ordering import running_totals
from riskloom.functions.tails import chi_square_upper, ks_two_sided, normal_two_sided
from riskloom.operators.clean import columns_by_type, value_counts_long
from riskloom.runtime import attach_small, materialize

# Change-log wording.
NUMERIC_KIND = "numérico"
CATEGORY_KIND = "categórico"
CATEGORY_CHANGE = "reajuste distribución"
DIRECTIONS = ("subir", "bajar", "ambos")

# Severity levels with their actions, in rising order.
SEVERITY = (
    ("🟢 Sin drift detectable", "No se requiere acción."),
    ("🟡 Drift leve", "Monitorear próximas ejecuciones."),
    ("🟠 Drift moderado", "Revisar pipeline de features o data sources recientes."),
    ("🔴 Drift severo", "⚙️ Reentrenar modelo."),
)
NO_COLUMNS = "Ninguna"

# Test names as they appear in reports.
KS_NAME = "K-S p_value"
CHI_NAME = "chi-square p_value"
Z_NAME = "Z-test p_value"

INLINE_VALUES = 500


# ---- injection -------------------------------------------------------------------------------------


def column_direction(seed: int, column: str) -> str:
    """Direction of a numeric column's shift, drawn from seed and name."""
    import hashlib

    return DIRECTIONS[int(hashlib.md5(f"{seed}:direction:{column}".encode()).hexdigest()[:8], 16) % 3]


def inject_drift(
    df: DataFrame,
    key: str,
    intensity: float = 0.2,
    seed: int = 42,
    target: str | None = None,
    exclude: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Shift numeric columns by noise and redistribute categorical ones; returns (table, change log).

    Numeric noise is normal with deviation ``intensity`` times the column's, added, subtracted or left
    signed. Every draw is a digest of seed, column and row key, so the result is the same however the
    table is partitioned and whichever tasks are run again.
    """
    protected = {c for c in [key, target, *exclude] if c}
    numeric = [c for c in columns_by_type(df, True) if c not in protected]
    texts = [n for n, t in df.dtypes if t == "string" and n not in protected]
    changes: list[tuple[str, str, str]] = []
    if numeric:
        row = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(numeric)]).first()
        shifted = {}
        for i, c in enumerate(numeric):
            std = row[f"s{i}"]
            if std is None or std == 0 or math.isnan(std):
                continue
            way = column_direction(seed, c)
            noise = normal(draw_hash(f"{seed}:{c}", F.col(key))) * F.lit(intensity * std)
            if way != "ambos":
                noise = F.abs(noise) if way == "subir" else -F.abs(noise)
            shifted[c] = F.col(c).cast("double") + noise
            changes.append((c, NUMERIC_KIND, way))
        df = df.withColumns(shifted) if shifted else df
    if texts:
        counted = value_counts_long(df, texts).where(F.col("value").isNotNull()).select("column", "value")
        values = materialize(counted, "values")
        sizes = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        for c in texts:
            if sizes.get(c, 0) >= 2:
                df = _redistribute(df, c, values.where(F.col("column") == c), sizes[c], key, seed)
                changes.append((c, CATEGORY_KIND, CATEGORY_CHANGE))
    log = df.sparkSession.createDataFrame(changes, "column string, kind string, direction string")
    return df, log


def _redistribute(df: DataFrame, column: str, values: DataFrame, size: int, key: str, seed: int) -> DataFrame:
    """Redraw the non-null values of a column from random (Dirichlet(1)) shares.

    Few values become a literal list of cumulative limits. Many values become a table of intervals that is
    joined on a slice of [0, 1); draws are uniform, so the slices are even and no interval is hot.
    """
    weight = -F.log(F.lit(1.0) - uniform(draw_hash(f"{seed}:share:{column}", F.col("value"))))
    draw = uniform(draw_hash(f"{seed}:pick:{column}", F.col(key)))
    weighted = values.select("value", weight.alias("w"))
    if size <= INLINE_VALUES:
        rows = sorted(weighted.collect(), key=lambda r: r["value"])
        total = sum(r["w"] for r in rows)
        limits, run = [], 0.0
        for r in rows[:-1]:
            run += r["w"]
            limits.append(run / total)
        names = F.array(*[F.lit(r["value"]) for r in rows])
        place = F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda t: t <= draw)) + 1
        return df.withColumn(column, F.when(F.col(column).isNotNull(), F.element_at(names, place)))
    run = running_totals(weighted, [], "value", ["w"])
    total = weighted.agg(F.sum("w")).first()[0]
    slices = max(1, size // 50)
    spans = run.select(
        F.col("value").alias("_new"),
        ((F.col("cum_w") - F.col("w")) / F.lit(total)).alias("_lo"),
        (F.col("cum_w") / F.lit(total)).alias("_hi"),
    ).withColumn(
        "_slice",
        F.explode(
            F.sequence(
                F.greatest(F.floor(F.col("_lo") * slices) - 1, F.lit(0)), F.least(F.floor(F.col("_hi") * slices) + 1, F.lit(slices))
            )
        ),
    )
    # neighbouring limits are compared as given, so every draw falls into exactly one half-open interval
    spans = spans.withColumn("_next", F.lead("_lo").over(Window.partitionBy("_slice").orderBy("_lo")))
    drawn = df.withColumn("_u", draw).withColumn("_slice", F.floor(F.col("_u") * slices))
    inside = (F.col("_u") >= F.col("_lo")) & (F.col("_next").isNull() | (F.col("_u") < F.col("_next")))
    spans = spans.withColumnRenamed("_slice", "_slice2")
    joined = drawn.join(spans, (F.col("_slice") == F.col("_slice2")) & inside, "left")
    fresh = F.when(F.col(column).isNotNull(), F.coalesce("_new", F.col(column)))
    return joined.withColumn(column, fresh).drop("_u", "_slice", "_slice2", "_new", "_lo", "_hi", "_next")


# ---- tests -----------------------------------------------------------------------------------------


def _long_values(df: DataFrame, columns: Sequence[str], numeric: set[str], side: str) -> DataFrame:
    """(column, num, txt, n_ref, n_cur): one row per value that is there, counted on its own side."""
    parts = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"),
            (F.lit(None).cast("string") if c in numeric else F.col(c).cast("string")).alias("txt"),
        )
        for c in columns
    ]
    ones = [F.lit(int(n == side)).cast("bigint").alias(n) for n in ("n_ref", "n_cur")]
    long = df.select(F.inline(F.array(*parts)), *ones)
    return long.where((F.col("num").isNotNull() & ~F.isnan("num")) | F.col("txt").isNotNull())


def _counted(long: DataFrame) -> DataFrame:
    return long.groupBy("column", "num", "txt").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def reference_counts(ref: DataFrame, target: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Stored value counts of a reference table, for comparisons with many later tables."""
    roles = column_roles(ref, target, columns)
    numeric = {c for c, r in roles.items() if r == "num"}
    return materialize(_counted(_long_values(ref, list(roles), numeric, "n_ref")), "reference")


def column_roles(df: DataFrame, target: str | None, columns: Sequence[str] | None = None) -> dict[str, str]:
    """``num`` or ``cat`` per column; the target is always ``cat``."""
    out = {}
    for f in df.schema.fields:
        if columns is None or f.name in columns:
            number = isinstance(f.dataType, T.NumericType) and f.name != target
            out[f.name] = "num" if number else "cat"
    return out


def ks_distance(counts: DataFrame) -> DataFrame:
    """Largest gap between the two cumulative shares, per column."""
    run = running_totals(counts.select("column", "num", "n_ref", "n_cur"), ["column"], "num", ["n_ref", "n_cur"], stored=True)
    sizes = counts.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    joined = attach_small(run, sizes, ["column"])
    gap = F.abs(F.col("cum_n_ref") / F.col("t_ref") - F.col("cum_n_cur") / F.col("t_cur"))
    return joined.groupBy("column").agg(F.max(gap).alias("statistic"))


def chi_square_distance(counts: DataFrame) -> DataFrame:
    """Sum of (observed - expected)^2 / expected with reference shares as expectation, per column."""
    sizes = counts.groupBy("column").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    joined = attach_small(counts, sizes, ["column"])
    expected = F.col("n_ref") * F.col("t_cur") / F.col("t_ref")
    gap = F.col("n_cur") - expected
    part = F.when(expected > 0, gap * gap / expected).when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(0.0)
    return joined.groupBy("column").agg(F.sum(part).alias("statistic"))


def proportion_z(counts: DataFrame) -> DataFrame:
    """Two-proportion z of the smallest value's share, per column; 0 where there is only one value."""
    smallest = counts.groupBy("column").agg(
        F.min_by("n_ref", F.struct("num", "txt")).alias("a_ref"),
        F.min_by("n_cur", F.struct("num", "txt")).alias("a_cur"),
        F.sum("n_ref").cast("double").alias("t_ref"),
        F.sum("n_cur").cast("double").alias("t_cur"),
    )
    p1, p2 = F.col("a_ref") / F.col("t_ref"), F.col("a_cur") / F.col("t_cur")
    pool = (F.col("a_ref") + F.col("a_cur")) / (F.col("t_ref") + F.col("t_cur"))
    spread = F.sqrt(pool * (1 - pool) * (1 / F.col("t_ref") + 1 / F.col("t_cur")))
    return smallest.select("column", F.when(spread > 0, (p1 - p2) / spread).otherwise(0.0).alias("statistic"))


@F.pandas_udf(T.DoubleType())
def _p_value(
    test: pd.Series, statistic: pd.Series, dof: pd.Series, n_ref: pd.Series, n_cur: pd.Series, method: pd.Series
) -> pd.Series:
    """One probability per report row (a row is a whole column of data)."""

    def one(t, s, k, a, b, how):
        if pd.isna(s):
            return None
        if t == KS_NAME:
            return ks_two_sided(float(s), int(a), int(b), how)
        if t == CHI_NAME:
            return chi_square_upper(float(s), int(k))
        return normal_two_sided(float(s))

    return pd.Series([one(*row) for row in zip(test, statistic, dof, n_ref, n_cur, method)], dtype="float64")


def drift_statistics(
    ref: DataFrame, cur: DataFrame, target: str | None = None, columns: Sequence[str] | None = None,
    counted: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Per column the chosen test and its statistic; also the stored value counts it came from.

    ``counted`` (from ``reference_counts``) spares reading the reference again; of ``ref`` only the schema is used then.

    Both tables are counted once by (column, value); every test and every histogram reads that small table.
    Test choice by number of values on both sides: numeric above 5 values Kolmogorov-Smirnov, up to 2 values
    z-test, everything else chi-square.
    """
    roles = column_roles(ref, target, columns)
    numeric = {c for c, r in roles.items() if r == "num"}
    left = _long_values(ref, list(roles), numeric, "n_ref") if counted is None else counted
    counts = materialize(_counted(left.unionByName(_long_values(cur, list(roles), numeric, "n_cur"))), "drift")
    kind = F.when(F.col("column").isin(sorted(numeric)), "num").otherwise("cat")
    shape = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur")
    )
    test = (
        F.when(F.col("n_values") <= 2, Z_NAME)
        .when((F.col("column_type") == "num") & (F.col("n_values") > 5), KS_NAME)
        .otherwise(CHI_NAME)
    )
    shape = shape.withColumn("column_type", kind).withColumn("stattest", test)
    chosen = {r["column"]: r["stattest"] for r in shape.select("column", "stattest").collect()}
    parts = []
    for name, fn in ((KS_NAME, ks_distance), (CHI_NAME, chi_square_distance), (Z_NAME, proportion_z)):
        mine = [c for c, t in chosen.items() if t == name]
        if mine:
            parts.append(fn(counts.where(F.col("column").isin(mine))))
    stats = parts[0]
    for p in parts[1:]:
        stats = stats.unionByName(p)
    return shape.join(stats, "column", "left"), counts


def drift_report(
    ref: DataFrame,
    cur: DataFrame,
    target: str | None = None,
    columns: Sequence[str] | None = None,
    threshold: float = 0.05,
    with_density: bool = True,
    ks_method: str = "limit",
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per column: type, test, p-value as drift score, verdict and 10-bin densities of numeric columns.

    Categorical columns may have any number of values, so their shapes are rows: see ``drift_shapes``.
    ``ks_method`` is ``limit`` or ``exact``, at every size.
    """
    return _report(*drift_statistics(ref, cur, target, columns, counted), threshold, with_density, ks_method)


def drift_report_and_shapes(
    ref: DataFrame,
    cur: DataFrame,
    target: str | None = None,
    columns: Sequence[str] | None = None,
    threshold: float = 0.05,
    ks_method: str = "limit",
) -> tuple[DataFrame, DataFrame]:
    """The report and the shapes of all its columns, from one count of both tables."""
    stats, counts = drift_statistics(ref, cur, target, columns)
    return _report(stats, counts, threshold, False, ks_method), drift_shapes(counts)


def _report(stats: DataFrame, counts: DataFrame, threshold: float, with_density: bool, ks_method: str) -> DataFrame:
    p = _p_value("stattest", "statistic", (F.col("n_values") - 1).cast("int"), "rows_ref", "rows_cur", F.lit(ks_method))
    report = stats.withColumn("drift_score", p).select(
        "column",
        "column_type",
        "stattest",
        F.lit(threshold).alias("threshold"),
        "statistic",
        "drift_score",
        F.coalesce(F.col("drift_score") < threshold, F.lit(False)).alias("drift_detected"),
    )
    if with_density:
        report = report.join(side_densities(counts), "column", "left")
    return report


def category_counts(counts: DataFrame) -> DataFrame:
    """(column, value, n_ref, n_cur) of the categorical columns, in long form for any number of values."""
    return counts.where(F.col("txt").isNotNull()).select("column", F.col("txt").alias("value"), "n_ref", "n_cur")


def drift_shapes(counts: DataFrame) -> DataFrame:
    """(column, side, label, x, y) of every column in long form.

    Numeric columns have ten rows per side with lower bin limit and density, categorical ones a row per value and side
    with its count, 0 where a side lacks the value.
    """
    shapes = side_densities(counts)
    parts = []
    for side, n in (("current", "n_cur"), ("reference", "n_ref")):
        bins = shapes.select("column", F.posexplode(f"{side}.y").alias("bin", "y"), F.col(f"{side}.x").alias("edges"))
        lower = F.get("edges", F.col("bin"))
        parts.append(bins.select("column", F.lit(side).alias("side"), F.lit(None).cast("string").alias("label"), lower.alias("x"), "y"))
        parts.append(
            category_counts(counts).select(
                "column", F.lit(side).alias("side"), F.col("value").alias("label"), F.lit(None).cast("double").alias("x"),
                F.col(n).cast("double").alias("y"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def side_densities(counts: DataFrame, bins: int = 10) -> DataFrame:
    """Per column a struct (x, y) for each side: bin limits and densities of numeric columns."""
    one_side = counts.select("column", "num", F.lit("reference").alias("side"), F.col("n_ref").alias("n")).unionByName(
        counts.select("column", "num", F.lit("current").alias("side"), F.col("n_cur").alias("n"))
    )
    one_side = one_side.where(F.col("num").isNotNull() & (F.col("n") > 0))
    span = one_side.groupBy("column", "side").agg(
        F.min("num").alias("lo"), F.max("num").alias("hi"), F.sum("n").alias("total")
    )
    # a constant column gets a bin range of width one around its value
    flat = F.col("lo") == F.col("hi")
    span = span.withColumns({"lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
                             "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))})
    placed = attach_small(one_side, span, ["column", "side"])
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.floor((F.col("num") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    binned = placed.withColumn("bin", place.cast("int")).withColumn("width", width)
    sums = [F.sum(F.when(F.col("bin") == b, F.col("n")).otherwise(0)).alias(f"b{b}") for b in range(bins)]
    wide = binned.groupBy("column", "side", "lo", "hi", "width", "total").agg(*sums)
    x = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.col("lo") + i * F.col("width"))
    y = F.array(*[F.col(f"b{b}") / (F.col("total") * F.col("width")) for b in range(bins)])
    shaped = wide.select("column", "side", F.struct(x.alias("x"), y.alias("y"), F.lit(None).cast("array<string>").alias("labels")).alias("d"))
    return shaped.groupBy("column").pivot("side", ["current", "reference"]).agg(F.first("d"))


# ---- monitor ---------------------------------------------------------------------------------------


def roll_up(report: DataFrame) -> DataFrame:
    """Columns, drifted columns and their share."""
    return report.agg(
        F.count(F.lit(1)).alias("total_columns"),
        F.count(F.when(F.col("drift_detected"), 1)).alias("drifted_columns"),
    ).withColumn(
        "drift_share",
        F.when(F.col("total_columns") > 0, F.col("drifted_columns") / F.col("total_columns")).otherwise(F.lit(0.0)),
    )


def severity(share: Column, slight_below: float = 0.2, moderate_below: float = 0.5) -> tuple[Column, Column]:
    """(level, action) of a share of drifted columns."""

    def pick(part: int) -> Column:
        return (
            F.when(share == 0, SEVERITY[0][part])
            .when(share < slight_below, SEVERITY[1][part])
            .when(share < moderate_below, SEVERITY[2][part])
            .otherwise(SEVERITY[3][part])
        )

    return pick(0), pick(1)


def dataset_drift(report: DataFrame, share: float = 0.5) -> DataFrame:
    """Whole-table verdict: is at least this share of the columns drifted."""
    return roll_up(report).withColumn("dataset_drift", F.col("drift_share") >= share)


def most_drifted(report: DataFrame, n: int = 5) -> DataFrame:
    """Drifted columns with the smallest p-values."""
    return report.where("drift_detected").orderBy("drift_score", "column").limit(n)


def monitor_record(report: DataFrame, source: str, top: int = 5, slight_below: float = 0.2) -> DataFrame:
    """One log row: roll-up, severity, action and the names of the most drifted columns."""
    level, action = severity(F.col("drift_share"), slight_below)
    names = most_drifted(report, top).agg(
        F.array_sort(F.collect_list(F.struct("drift_score", "column"))).alias("found")
    )
    text = F.concat_ws(", ", F.transform("found", lambda s: s["column"]))
    rolled = roll_up(report).withColumn("_k", F.lit(0))
    named = names.select(F.lit(0).alias("_k"), F.when(F.size("found") > 0, text).otherwise(NO_COLUMNS).alias("top_columns_drift"))
    return rolled.join(named, "_k").select(
        F.current_timestamp().alias("timestamp"),
        "total_columns",
        "drifted_columns",
        "drift_share",
        level.alias("level"),
        action.alias("action"),
        F.lit(source).alias("source"),
        "top_columns_drift",
    )


def monitor(
    ref: DataFrame, cur: DataFrame, log_path: str, source: str, target: str | None = None, top: int = 5,
    counted: DataFrame | None = None, mode: str = "append",
) -> DataFrame:
    """Report, roll up, classify and write one row to the drift log; returns that row."""
    report = materialize(drift_report(ref, cur, target, with_density=False, counted=counted), "report")
    record = materialize(monitor_record(report, source, top), "record")
    record.write.mode(mode).parquet(log_path)
    return record

