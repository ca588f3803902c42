"""The cleaner: rename, drop, text rules, coercion, caps, rare categories, target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import CleanSpec
from riskloom.functions.ordering import long_form, row_numbers
from riskloom.functions.text import cap_to_null, invert_binary, junk_to_null, nan_to_null, strip_all, strip_ends, to_num
from riskloom.runtime import attach_small, materialize, tune

# Up to this many kept (or rare) values per table are compared as literals inside the scan.
INLINE_VALUES = 500


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names given for {len(df.columns)} columns")
    return df.toDF(*names)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; an unknown name is an error, not a silent no-op."""
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"cannot drop unknown columns: {unknown}")
    return df.drop(*columns) if columns else df


def text_rule(c: Column, spec: CleanSpec) -> Column:
    """White-space rule, then junk list, for one text."""
    strip = strip_all if spec.whitespace == "remove" else strip_ends
    return junk_to_null(strip(c), spec.junk)


def clean_text(df: DataFrame, columns: Sequence[str], spec: CleanSpec) -> DataFrame:
    """White-space rule and junk list on the categorical columns that exist."""
    return df.withColumns({c: text_rule(F.col(c), spec) for c in columns if c in df.columns})


def as_number(df: DataFrame, column: str) -> Column:
    """The column as double, null where it is no number; text parsing only where the column is text."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return nan_to_null(F.col(column).cast("double"))
    return to_num(F.col(column))


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: as_number(df, c) for c in columns if c in df.columns})


def cap_outliers(df: DataFrame, caps: dict[str, float]) -> DataFrame:
    """Values strictly above the cap become null; they are not clipped to it."""
    return df.withColumns({c: cap_to_null(F.col(c).cast("double"), cap) for c, cap in caps.items() if c in df.columns})


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per (column, value), nulls included, in one shuffle with map-side combine."""
    return long_form(df, list(columns)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def rare_counts(df: DataFrame, columns: Sequence[str], rule=None) -> DataFrame:
    """(column, value, n) after a text rule, which runs on the distinct raw values instead of on every row."""
    counts = value_counts_long(df, columns)
    if rule is None:
        return counts
    return counts.withColumn("value", rule(F.col("value"))).groupBy("column", "value").agg(F.sum("n").alias("n"))


def keep_frequent(
    df: DataFrame,
    columns: Sequence[str],
    counts: DataFrame,
    min_count: int,
    count_nulls: bool = False,
    min_share: float | None = None,
) -> DataFrame:
    """Null for the values of ``columns`` whose entry in ``counts`` is too small.

    The shorter of the two value lists (kept or rare) is tested inside the scan if it is short. Otherwise
    the kept values are joined, broadcast only if they were counted as few, else with AQE free to split a
    hot value.
    """
    if not count_nulls:
        counts = counts.where(F.col("value").isNotNull())
    rare: Column = F.col("n") < F.lit(min_count)
    if min_share is not None:
        total = df.count()
        rare = rare | (F.col("n") < F.lit(min_share * total))
    flagged = materialize(counts.select("column", "value", rare.alias("rare")), "counts").where(F.col("value").isNotNull())
    sizes = flagged.agg(F.count(F.when(F.col("rare"), 1)).alias("rare"), F.count(F.when(~F.col("rare"), 1)).alias("kept")).first()
    if sizes["rare"] == 0:
        return df
    want_rare = sizes["rare"] < sizes["kept"]
    if min(sizes["rare"], sizes["kept"]) <= INLINE_VALUES:
        rows = flagged.where(F.col("rare") == want_rare).collect()
        out = {}
        for c in columns:
            listed = [r["value"] for r in rows if r["column"] == c]
            text = F.col(c).cast("string")
            if want_rare:
                out[c] = F.when(~text.isin(listed), F.col(c)) if listed else F.col(c)
            else:
                out[c] = F.when(text.isin(listed), F.col(c)) if listed else F.lit(None).cast(df.schema[c].dataType)
        return df.withColumns(out)
    for c in columns:
        kept = flagged.where((F.col("column") == c) & ~F.col("rare")).select(F.col("value").alias("_kept"))
        df = attach_small(df.withColumn("_kept", F.col(c).cast("string")), kept.withColumn("_hit", F.lit(True)), ["_kept"])
        df = df.withColumn(c, F.when(F.col("_hit"), F.col(c))).drop("_kept", "_hit")
    return df


def null_rare(
    df: DataFrame,
    columns: Sequence[str],
    min_count: int,
    count_nulls: bool = False,
    min_share: float | None = None,
) -> DataFrame:
    """Null for categories seen fewer than ``min_count`` times (or in less than ``min_share`` of the rows).

    All columns are counted together in one shuffle of their distinct values.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    return keep_frequent(df, columns, rare_counts(df, columns), min_count, count_nulls, min_share)


def valid_target(df: DataFrame, target: str) -> DataFrame:
    """Keep the rows whose target is a number equal to 0 or 1."""
    return df.withColumn(target, as_number(df, target)).where(F.col(target).isin(0.0, 1.0))


def dropped_by_target(df: DataFrame, target: str) -> DataFrame:
    """How many rows the target rule keeps and drops, without a second pass over the data."""
    ok = F.coalesce(as_number(df, target).isin(0.0, 1.0), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(F.when(ok, 1)).alias("rows_kept"),
        F.count(F.when(~ok, 1)).alias("rows_dropped"),
    )


def write_valid(df: DataFrame, target: str, path: str, expected: int | None = None) -> DataFrame:
    """Write the rows with a valid target and return (rows_before, rows_kept, rows_dropped, expected, unchanged) as one row.

    Rows before are counted without reading a column that the plan does not need, rows kept from the files written. ``expected`` is
    compared with the rows before; without it ``unchanged`` is null. ``DataFrame.observe`` would count while writing, but leaves a part in
    the session that cannot be serialised, and Spark's models with a training summary then fail in every later job.
    """
    before = df.count()
    valid_target(df, target).write.mode("overwrite").parquet(path)
    kept = df.sparkSession.read.parquet(path).count()
    row = (before, kept, before - kept, expected, None if expected is None else before == expected)
    return df.sparkSession.createDataFrame([row], "rows_before long, rows_kept long, rows_dropped long, expected long, unchanged boolean")


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.na.drop(subset=[target])


def invert_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, invert_binary(F.col(target)))


def reset_index(df: DataFrame, key: str, name: str = "index") -> DataFrame:
    """0..n-1 in order of a unique key; only for callers that really need positions."""
    return row_numbers(df, key, name).withColumn(name, F.col(name) - 1)


def clean_data(df: DataFrame, spec: CleanSpec, keep: Sequence[str] = ()) -> DataFrame:
    """All cleaning rules in their fixed order.

    Rename, drop, text rules, numeric coercion, caps, rare categories (counted before rows are dropped),
    target filter, target inversion. Everything but the rare-category count is a narrow projection that
    Catalyst folds into the scan. ``keep`` names key columns that lead the raw table and are passed along.
    """
    tune(df.sparkSession)
    df = rename_by_position(df, list(keep) + list(spec.rename))
    df = drop_columns(df, spec.drop)
    categorical = [c for c in [*spec.features.nominal, *spec.features.ordinal] if c in df.columns]
    counts = rare_counts(df.select(*categorical), categorical, lambda v: text_rule(v, spec)) if categorical else None
    df = clean_text(df, categorical, spec)
    df = coerce_numeric(df, spec.features.numeric)
    if categorical:
        # caps change no category, so counting before them gives the counts after them; the few columns that
        # are both capped and categorical are counted again
        both = [c for c in categorical if c in spec.caps]
        df = cap_outliers(df, spec.caps)
        if both:
            counts = rare_counts(df, categorical)
        df = keep_frequent(df, categorical, counts, spec.min_count, spec.count_nulls, spec.min_share)
    else:
        df = cap_outliers(df, spec.caps)
    df = valid_target(df, spec.target)
    return invert_target(df, spec.target)


def convert_if_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Convert a text column to a number only if every value converts; whole numbers become bigint.

    One aggregation looks at all columns at once.
    """
    checks = []
    for i, c in enumerate(columns):
        number = to_num(F.col(c))
        checks.append(F.count(F.when(F.col(c).isNotNull() & number.isNull(), 1)).alias(f"bad_{i}"))
        # 2**63 and more is no bigint; such columns stay double.
        checks.append(F.count(F.when(number.isNull() | (number != F.floor(number)) | (F.abs(number) >= 2.0**63), 1)).alias(f"frac_{i}"))
    seen = df.agg(*checks).first()
    out = {}
    for i, c in enumerate(columns):
        if seen[f"bad_{i}"] == 0:
            # Straight from the text where it is spelled as an integer: a double holds only 53 bits.
            whole = F.coalesce(F.trim(F.col(c).cast("string")).try_cast("bigint"), to_num(F.col(c)).cast("bigint"))
            out[c] = whole if seen[f"frac_{i}"] == 0 else to_num(F.col(c))
    return df.withColumns(out) if out else df


def to_integers_strict(df: DataFrame) -> DataFrame:
    """Every column to bigint; a value that does not convert fails the job (ANSI cast)."""
    return df.select(*[F.col(c).cast("bigint").alias(c) for c in df.columns])


def columns_by_type(df: DataFrame, numeric: bool = True) -> list[str]:
    """Names of the numeric (or of the other) columns, from the schema alone."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) == numeric]


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """Turn floating NaN into null in every double or float column."""
    kinds = {"double", "float"}
    return df.withColumns({n: nan_to_null(F.col(n)) for n, t in df.dtypes if t in kinds})
