"""Feature stages as ``pyspark.ml`` estimators; fits are aggregations, transforms are column expressions."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.config import FeatureSpec
from riskloom.functions.ordering import exact_quantiles, long_form, ordered_index
from riskloom.functions.text import nan_to_null, to_num
from riskloom.operators.clean import value_counts_long
from riskloom.runtime import collect_bounded, scratch_path

# Categories that a stage holds in its state; a stage of more keeps them as a table and joins it, with the same result.
HELD_CATEGORIES = 100_000


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Shared parts: several columns in, several out, options and fitted state as JSON text."""

    option = Param(Params._dummy(), "option", "variant of the stage", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, option=None, state=None):
        super().__init__()
        kwargs = self._input_kwargs
        self._setDefault(option="", state="null")
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols()))

    def fitted(self):
        return json.loads(self.getOrDefault(self.state))

    def _model(self, cls, state):
        return cls(
            inputCols=self.getInputCols(),
            outputCols=self.getOutputCols(),
            option=self.getOrDefault(self.option),
            state=json.dumps(state),
        )


class NumberCast(_Columns, Transformer):
    """Lenient conversion of columns to double."""

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for i, o in self.pairs():
            numeric = isinstance(df.schema[i].dataType, T.NumericType)
            out[o] = nan_to_null(F.col(i).cast("double")) if numeric else to_num(F.col(i))
        return df.withColumns(out)


class TextCast(_Columns, Transformer):
    """Columns as text, null spelled ``nan`` so that it is a category like any other."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({o: F.coalesce(F.col(i).cast("string"), F.lit("nan")) for i, o in self.pairs()})


class DropColumns(_Columns, Transformer):
    """Remove intermediate columns at the end of a pipeline."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getInputCols())


class ValueImputer(_Columns, Estimator):
    """Replace nulls by mean, exact median or most frequent value (smallest on a tie)."""

    def _fit(self, df: DataFrame) -> "ValueImputerModel":
        cols, how = self.getInputCols(), self.getOrDefault(self.option) or "mean"
        if how == "mean":
            row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
            values = [row[f"v{i}"] for i in range(len(cols))]
        elif how == "median":
            q = exact_quantiles(df, cols, [0.5])
            values = [q[(c, 0.5)] for c in cols]
        elif how == "most_frequent":
            values = most_frequent(df, cols)
        else:
            raise ValueError(f"unknown imputation strategy: {how}")
        return self._model(ValueImputerModel, values)


class ValueImputerModel(_Columns, Model):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for (i, o), v in zip(self.pairs(), self.fitted()):
            c = F.col(i)
            if self.getOrDefault(self.option) != "most_frequent":
                c = c.cast("double")
            out[o] = c if v is None else F.coalesce(c, F.lit(v))
        return df.withColumns(out)


def most_frequent(df: DataFrame, columns: Sequence[str]) -> list:
    """Most frequent value per column; ties go to the smallest, numbers compared as numbers.

    All text columns share one count pass and all numeric ones another, so types keep their order.
    """
    found: dict = {}
    for numeric in (True, False):
        part = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType) == numeric]
        if not part:
            continue
        counts = (
            long_form(df, part, kind="double" if numeric else "string")
            .where(F.col("value").isNotNull())
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        top = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("v"))
        found.update({r["column"]: r["v"] for r in top.collect()})
    return [found.get(c) for c in columns]


class UnitScaler(_Columns, Estimator):
    """(x - min) / (max - min); a constant column becomes 0 and unseen values are not clipped."""

    def _fit(self, df: DataFrame) -> "UnitScalerModel":
        cols = self.getInputCols()
        row = df.agg(
            *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
            *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
        ).first()
        state = []
        for i in range(len(cols)):
            lo, hi = row[f"lo{i}"], row[f"hi{i}"]
            state.append((lo or 0.0, (hi - lo) or 1.0) if lo is not None else (0.0, 1.0))
        return self._model(UnitScalerModel, state)


class UnitScalerModel(_Columns, Model):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                o: (F.col(i).cast("double") - F.lit(float(lo))) / F.lit(float(width))
                for (i, o), (lo, width) in zip(self.pairs(), self.fitted())
            }
        )


class ZScaler(_Columns, Estimator):
    """(x - mean) / population deviation; a constant column becomes 0."""

    def _fit(self, df: DataFrame) -> "ZScalerModel":
        return self._model(ZScalerModel, _mean_and_deviation(df, [F.col(c) for c in self.getInputCols()]))


def _mean_and_deviation(df: DataFrame, columns: list[Column]) -> list:
    row = df.agg(
        *[F.avg(c.cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c.cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return [(row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i in range(len(columns))]


class ZScalerModel(_Columns, Model):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                o: (F.col(i).cast("double") - F.lit(float(m))) / F.lit(float(s))
                for (i, o), (m, s) in zip(self.pairs(), self.fitted())
            }
        )


def yeo_johnson(x: Column, lam) -> Column:
    """The Yeo-Johnson power transform (Yeo and Johnson, 2000) at a lambda given as number or column."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    up = F.when(lam == 0, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / F.nullif(lam, F.lit(0.0)))
    rest = F.lit(2.0) - lam
    down = F.when(rest == 0, -F.log1p(-x)).otherwise(-(F.pow(1 - x, rest) - 1) / F.nullif(rest, F.lit(0.0)))
    return F.when(x >= 0, up).otherwise(F.when(x < 0, down))


def fit_lambdas(df: DataFrame, columns: Sequence[str], points: int = 17, passes: int = 4) -> list[float]:
    """Lambda of largest likelihood per column.

    Every pass scores a grid of lambdas for all columns in one aggregation with map-side combine and then
    narrows the grid around the best one, so the number of passes is fixed whatever the data size. A best
    lambda at the edge moves the grid instead.
    """
    values = df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)]
            )
        )
    ).where(F.col("x").isNotNull())
    span = [(-10.0, 10.0)] * len(columns)
    middle, left = [1.0] * len(columns), [passes] * len(columns)
    for _ in range(passes + 8):
        steps = [(hi - lo) / (points - 1) for lo, hi in span]
        starts = F.element_at(F.array(*[F.lit(lo) for lo, _ in span]), F.col("c") + 1)
        widths = F.element_at(F.array(*[F.lit(w) for w in steps]), F.col("c") + 1)
        tried = values.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
            "t", yeo_johnson(F.col("x"), starts + F.col("k") * widths)
        )
        rows = (
            tried.groupBy("c", "k")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.var_pop("t").alias("v"),
                F.sum(F.signum("x") * F.log1p(F.abs("x"))).alias("g"),
            )
            .collect()
        )
        scores: list[dict[int, float]] = [{} for _ in columns]
        for r in rows:
            lam = span[r["c"]][0] + r["k"] * steps[r["c"]]
            if r["v"] and math.isfinite(r["v"]) and r["v"] > 0:
                scores[r["c"]][r["k"]] = -r["n"] / 2 * math.log(r["v"]) + (lam - 1) * r["g"]
        for i, (lo, hi) in enumerate(span):
            at = _peak(scores[i])
            if left[i] == 0 or at is None:
                left[i] = 0
                continue
            middle[i] = lo + at * steps[i]
            edge = at in (0.0, float(points - 1))
            reach = (hi - lo) / 2 if edge else steps[i]
            left[i] -= 0 if edge else 1
            span[i] = (middle[i] - reach, middle[i] + reach)
        if not any(left):
            break
    return middle


def _peak(scores: dict[int, float]) -> float | None:
    """Grid position of the maximum, refined by the parabola through it and its two neighbours."""
    if not scores:
        return None
    k = max(scores, key=lambda i: (scores[i], -i))
    left, right = scores.get(k - 1), scores.get(k + 1)
    if left is None or right is None or left + right - 2 * scores[k] == 0:
        return float(k)
    return k + 0.5 * (left - right) / (left + right - 2 * scores[k])


class YeoJohnson(_Columns, Estimator):
    """Power transform at the most likely lambda, then centred and scaled by the population deviation."""

    def _fit(self, df: DataFrame) -> "YeoJohnsonModel":
        cols = self.getInputCols()
        lambdas = fit_lambdas(df, cols)
        moments = _mean_and_deviation(df, [yeo_johnson(F.col(c).cast("double"), lam) for c, lam in zip(cols, lambdas)])
        return self._model(YeoJohnsonModel, [(lam, m, s) for lam, (m, s) in zip(lambdas, moments)])


class YeoJohnsonModel(_Columns, Model):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                o: (yeo_johnson(F.col(i).cast("double"), lam) - F.lit(m)) / F.lit(s)
                for (i, o), (lam, m, s) in zip(self.pairs(), self.fitted())
            }
        )


def category_lists(df: DataFrame, columns: Sequence[str]) -> list[list[str]] | None:
    """Sorted categories per column as text, numeric columns sorted as numbers; ``None`` if there are more than a stage holds."""
    rows = collect_bounded(value_counts_long(df, columns).where(F.col("value").isNotNull()), HELD_CATEGORIES)
    if rows is None:
        return None
    out = []
    for c in columns:
        found = [r["value"] for r in rows if r["column"] == c]
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        out.append(sorted(found, key=float) if numeric else sorted(found))
    return out


def category_table(df: DataFrame, columns: Sequence[str]) -> tuple[str, list[int]]:
    """Path of a stored table (k, value, position) with the sorted categories of column number k, and how many each column has."""
    whole = None
    for k, c in enumerate(columns):
        index = ordered_index(df.select(nan_to_null(F.col(c)).alias(c) if isinstance(df.schema[c].dataType, T.DoubleType) else c), c, "position")
        part = index.select(F.lit(k).alias("k"), F.col(c).cast("string").alias("value"), F.col("position").cast("long").alias("position"))
        whole = part if whole is None else whole.unionByName(part)
    path = scratch_path(df.sparkSession, "categories")
    whole.write.partitionBy("k").parquet(path)
    counts = {r["k"]: r["n"] for r in read_categories(df.sparkSession, path).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    return path, [counts.get(k, 0) for k in range(len(columns))]


def read_categories(spark, path: str) -> DataFrame:
    return spark.read.schema("value string, position long, k int").parquet(path)


class _TableWriter(DefaultParamsWriter):
    """Saves a stage with its category table beside its parameters."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        held = self.instance.fitted()
        if isinstance(held, dict):
            read_categories(self.sparkSession, held["table"]).write.partitionBy("k").mode("overwrite").parquet(f"{path}/categories")


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        stage = super().load(path)
        held = stage.fitted()
        if isinstance(held, dict):
            stage.set(stage.state, json.dumps({**held, "table": f"{path}/categories"}))
        return stage


class _Categories(_Columns):
    """Fitted categories: lists in the state, or the path of a table and the number of categories per column."""

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)

    def counts(self) -> list[int]:
        held = self.fitted()
        return held["counts"] if isinstance(held, dict) else [len(labels) for labels in held]

    def with_positions(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """``df`` with the 0-based category position of each column; unknown ones have the number of categories."""
        held = self.fitted()
        if not isinstance(held, dict):
            return _positions(df, self.pairs(), held)
        # AQE broadcasts a column's categories where they are few and splits a hot category where they are not.
        table = read_categories(df.sparkSession, held["table"])
        names = []
        for k, ((i, _), n) in enumerate(zip(self.pairs(), held["counts"])):
            text, name = f"_text_{k}", f"_pos_{k}"
            side = table.where(F.col("k") == k).select(F.col("value").alias(text), F.col("position").alias(name))
            df = df.withColumn(text, F.col(i).cast("string")).join(side, text, "left").withColumn(name, F.coalesce(name, F.lit(n)).cast("double")).drop(text)
            names.append(name)
        return df, names


def _fitted_categories(stage: _Columns, cls, df: DataFrame):
    """Lists while they are few; a table otherwise, or where option ``table`` asks for one."""
    columns = stage.getInputCols()
    lists = None if stage.getOrDefault(stage.option) == "table" else category_lists(df, columns)
    if lists is None:
        path, counts = category_table(df, columns)
        return stage._model(cls, {"table": path, "counts": counts})
    return stage._model(cls, lists)


def _positions(df: DataFrame, pairs, lists) -> tuple[DataFrame, list[str]]:
    """Add the 0-based category position of each column (list length where unknown), looked up in the JVM."""
    texts = [f"_text_{k}" for k in range(len(pairs))]
    names = [f"_pos_{k}" for k in range(len(pairs))]
    df = df.withColumns({t: F.col(i).cast("string") for t, (i, _) in zip(texts, pairs)})
    for t, n, labels in zip(texts, names, lists):
        if not labels:
            df = df.withColumn(n, F.lit(0.0))
            continue
        lookup = StringIndexerModel.from_labels(labels, inputCol=t, outputCol=n, handleInvalid="keep")
        df = lookup.transform(df)
    return df.drop(*texts), names


class BinaryEncoder(_Columns, Estimator):
    """Category to the binary digits of its 1-based position; unknown gives all zeros.

    Output columns are ``<output>_0`` (highest digit) onwards.
    """

    def _fit(self, df: DataFrame) -> "BinaryEncoderModel":
        return _fitted_categories(self, BinaryEncoderModel, df)


class BinaryEncoderModel(_Categories, Model):
    def widths(self) -> list[int]:
        return [max(n.bit_length(), 1) for n in self.counts()]

    def output_names(self) -> list[str]:
        return [f"{o}_{b}" for (_, o), w in zip(self.pairs(), self.widths()) for b in range(w)]

    def _transform(self, df: DataFrame) -> DataFrame:
        df, names = self.with_positions(df)
        bits = {}
        for (_, o), many, n, w in zip(self.pairs(), self.counts(), names, self.widths()):
            code = F.when(F.col(n) < F.lit(many), F.col(n).cast("int") + 1).otherwise(F.lit(0))
            bits.update(binary_digits(code, o, w))
        return df.withColumns(bits).drop(*names)


def binary_digits(code: Column, name: str, width: int) -> dict[str, Column]:
    return {f"{name}_{b}": F.shiftright(code, width - 1 - b).bitwiseAND(F.lit(1)) for b in range(width)}


def binary_encode_by_join(df: DataFrame, column: str, name: str) -> DataFrame:
    """Binary digits for a column with any number of categories: sorted positions are joined, not held.

    The category table is written before the join, so AQE sees its size, broadcasts it when small and
    splits a hot category when not.
    """
    text = df.withColumn("_text", F.coalesce(F.col(column).cast("string"), F.lit("nan")))
    from riskloom.runtime import materialize

    positions = materialize(ordered_index(text, "_text", "_pos"), "categories")
    width = max(positions.count().bit_length(), 1)
    joined = text.join(positions, "_text", "left")
    return joined.withColumns(binary_digits((F.col("_pos") + 1).cast("int"), name, width)).drop("_text", "_pos")


class OrdinalIndex(_Columns, Estimator):
    """Category to its 0-based position in sorted order; unknown is -1, or an error with option ``error``."""

    def _fit(self, df: DataFrame) -> "OrdinalIndexModel":
        return _fitted_categories(self, OrdinalIndexModel, df)


class OrdinalIndexModel(_Categories, Model):
    def _transform(self, df: DataFrame) -> DataFrame:
        df, names = self.with_positions(df)
        out = {}
        for (i, o), many, n in zip(self.pairs(), self.counts(), names):
            known = F.col(n) < F.lit(many)
            if self.getOrDefault(self.option) == "error":
                message = F.concat(F.lit(f"unknown category in {i}: "), F.coalesce(F.col(i).cast("string"), F.lit("null")))
                unknown = F.raise_error(message).cast("double")
            else:
                unknown = F.lit(-1.0)
            out[o] = F.when(known, F.col(n)).otherwise(unknown)
        return df.withColumns(out).drop(*names)


class VectorOfColumns(_Columns, Transformer):
    """Assemble columns whose number is known only after fitting: all columns starting with a prefix."""

    def _transform(self, df: DataFrame) -> DataFrame:
        prefixes = self.getInputCols()
        names = [c for p in prefixes for c in df.columns if c == p or _is_digit_of(c, p)]
        return VectorAssembler(inputCols=names, outputCol=self.getOutputCols()[0]).transform(df)


def _is_digit_of(column: str, prefix: str) -> bool:
    return column.startswith(prefix + "_") and column[len(prefix) + 1 :].isdigit()


def one_hot_stages(columns: Sequence[str], outputs: Sequence[str]) -> list:
    """Sorted one-hot vectors; unknown and null become all zeros.

    The indexer's extra slot for unknown values is the last one, and the encoder drops exactly that.
    """
    mid = [f"{o}__ix" for o in outputs]
    return [
        StringIndexer(
            inputCols=list(columns), outputCols=mid, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=mid, outputCols=list(outputs), dropLast=True),
    ]


def build_preprocessor(spec: FeatureSpec, variant: str = "live", passthrough: Sequence[str] = ()) -> Pipeline:
    """Three column branches assembled into ``features`` in declared order.

    ``live``: numeric impute, 0..1 scale, Yeo-Johnson; nominal impute, binary digits; ordinal impute, 0..1
    scale. ``notebook``: as live with an ordinal index that refuses unknown codes. ``extended``: numeric
    median and z-scale, ordinal index with -1, nominal one-hot, in the order numeric, ordinal, nominal.
    Columns in ``passthrough`` follow unchanged; all others are left out of the vector.
    """
    if variant not in ("live", "notebook", "extended"):
        raise ValueError(f"unknown preprocessing variant: {variant}")
    stages: list = []
    temps: list[str] = []

    def step(cls, cols: list[str], suffix: str, **kw) -> list[str]:
        out = [f"{c}__{suffix}" for c in cols]
        stages.append(cls(inputCols=cols, outputCols=out, **kw))
        temps.extend(out)
        return out

    num, nom, ordi = [], [], []
    if spec.numeric:
        cols = step(NumberCast, list(spec.numeric), "num")
        if variant == "extended":
            num = step(ZScaler, step(ValueImputer, cols, "imp", option="median"), "z")
        else:
            how = spec.numeric_impute if variant == "live" else "median"
            num = step(YeoJohnson, step(UnitScaler, step(ValueImputer, cols, "imp", option=how), "unit"), "yj")
    if spec.nominal:
        cols = step(ValueImputer, list(spec.nominal), "nomimp", option=spec.nominal_impute)
        if variant == "extended":
            nom = [f"{c}__hot" for c in spec.nominal]
            stages.extend(one_hot_stages(cols, nom))
            temps.extend(nom + [f"{c}__ix" for c in nom])
        else:
            cols = step(TextCast, cols, "text")
            nom = [f"{c}__bit" for c in spec.nominal]
            stages.append(BinaryEncoder(inputCols=cols, outputCols=nom))
    if spec.ordinal:
        cols = list(spec.ordinal)
        if variant == "live":
            cols = step(NumberCast, cols, "ordnum")
        cols = step(ValueImputer, cols, "ordimp", option=spec.ordinal_impute)
        if variant == "live":
            ordi = step(UnitScaler, cols, "ordunit")
        else:
            ordi = step(OrdinalIndex, cols, "ordix", option="error" if variant == "notebook" else "")
    order = num + ordi + nom if variant == "extended" else num + nom + ordi
    stages.append(VectorOfColumns(inputCols=order + list(passthrough), outputCols=["features"]))
    stages.append(DropBranchColumns(inputCols=temps + nom, outputCols=[]))
    return Pipeline(stages=stages)


class DropBranchColumns(_Columns, Transformer):
    """Remove the branch columns, encoded digits included."""

    def _transform(self, df: DataFrame) -> DataFrame:
        prefixes = self.getInputCols()
        gone = set(prefixes)
        gone.update(c for c in df.columns if "__bit_" in c and c.rsplit("_", 1)[0] in gone)
        return df.drop(*[c for c in df.columns if c in gone])


def width_report(before: DataFrame, features: DataFrame, n_inputs: int, column: str = "features") -> DataFrame:
    """Input columns and length of the assembled vector, read from its metadata."""
    meta = features.schema[column].metadata.get("ml_attr", {})
    return before.sparkSession.createDataFrame(
        [(n_inputs, int(meta.get("num_attrs", 0)))], "columns_before int, columns_after int"
    )
