"""Classification metrics of scored tables; all groups (phase, fold, candidate) in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.ordering import running_totals

METRICS = ("accuracy", "precision", "recall", "f1", "gmean", "roc_auc")


def _cell(truth: int, guess: int, y: str, p: str) -> Column:
    hit = (F.col(y) == F.lit(truth)) & (F.col(p) == F.lit(guess))
    return F.count(F.when(hit, 1))


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    """a / b, or ``empty`` when there is nothing to divide by."""
    return F.when(b > 0, a / b).otherwise(F.lit(empty))


def confusion(df: DataFrame, groups: Sequence[str] = (), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """tn, fp, fn, tp per group: four conditional counts, so only one row per group and task is shuffled."""
    return df.groupBy(*groups).agg(
        _cell(0, 0, y, p).alias("tn"),
        _cell(0, 1, y, p).alias("fp"),
        _cell(1, 0, y, p).alias("fn"),
        _cell(1, 1, y, p).alias("tp"),
    )


def with_rates(cells: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 and G-mean from the four counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    return cells.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            # the geometric mean runs over the classes present, as for a single-class table
            "gmean": F.when(tp + fn == 0, ratio(tn, tn + fp))
            .when(tn + fp == 0, ratio(tp, tp + fn))
            .otherwise(F.sqrt(ratio(tp, tp + fn) * ratio(tn, tn + fp))),
        }
    )


def confusion_matrix(df: DataFrame, groups: Sequence[str] = (), y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """The nested array [[tn, fp], [fn, tp]]."""
    cells = confusion(df, groups, y, p)
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    return cells.select(*groups, matrix.alias("confusion_matrix"))


def _score_counts(df: DataFrame, groups: Sequence[str], y: str, score: str) -> DataFrame:
    truth = F.col(y)
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*groups, F.col(score).cast("double").alias("score"))
        .agg(
            F.count(F.when(truth == 1, 1)).alias("pos"),
            F.count(F.when(truth == 0, 1)).alias("neg"),
        )
    )


def roc_auc(df: DataFrame, groups: Sequence[str] = (), y: str = "y_true", score: str = "y_prob") -> DataFrame:
    """Exact area under the ROC curve with ties, null when a class is absent.

    Rows are grouped by score first; a positive beats the negatives below its score and half of those at
    it (Mann-Whitney).
    """
    groups = list(groups)
    run = running_totals(_score_counts(df, groups, y, score), groups, "score", ["neg"])
    wins = F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)
    sums = run.groupBy(*groups).agg(F.sum(wins).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    area = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("w") / (F.col("p").cast("double") * F.col("n")))
    return sums.select(*groups, area.alias("roc_auc"))


def classification_metrics(
    df: DataFrame,
    groups: Sequence[str] = (),
    y: str = "y_true",
    p: str = "y_pred",
    score: str | None = "y_prob",
) -> DataFrame:
    """Counts, rates and (with a score column) AUC, one row per group."""
    groups = list(groups)
    rates = with_rates(confusion(df, groups, y, p))
    if score is None:
        return rates
    area = roc_auc(df, groups, y, score)
    if groups:
        return rates.join(area, groups, "left")
    return rates.withColumn("_k", F.lit(0)).join(area.withColumn("_k", F.lit(0)), "_k", "left").drop("_k")


def evaluate_phases(df: DataFrame, phase: str = "phase", phases: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Metrics of each evaluation phase of one tagged, scored table."""
    return classification_metrics(df.where(F.col(phase).isin(*phases)), [phase])


def roc_curve(df: DataFrame, groups: Sequence[str] = (), y: str = "y_true", score: str = "y_prob") -> DataFrame:
    """One point per distinct score, highest first: a row is called positive at ``score`` and above."""
    groups = list(groups)
    counts = _score_counts(df, groups, y, score)
    run = running_totals(counts.withColumn("_down", -F.col("score")), groups, "_down", ["pos", "neg"])
    all_rows = df.where(F.col(score).isNotNull()).groupBy(*groups).agg(
        F.count(F.when(F.col(y) == 1, 1)).alias("_p"), F.count(F.when(F.col(y) == 0, 1)).alias("_n")
    )
    from riskloom.runtime import attach_small

    if not groups:
        run, all_rows, keys = run.withColumn("_k", F.lit(0)), all_rows.withColumn("_k", F.lit(0)), ["_k"]
    else:
        keys = groups
    joined = attach_small(run, all_rows, keys)
    return joined.select(
        *groups,
        F.col("score").alias("threshold"),
        F.when(F.col("_n") > 0, F.col("cum_neg") / F.col("_n")).alias("fpr"),
        F.when(F.col("_p") > 0, F.col("cum_pos") / F.col("_p")).alias("tpr"),
    )


def average_precision(df: DataFrame, groups: Sequence[str] = (), y: str = "y_true", score: str = "y_prob") -> DataFrame:
    """Sum over thresholds of precision times the recall gained there."""
    groups = list(groups)
    counts = _score_counts(df, groups, y, score).withColumn("_down", -F.col("score"))
    run = running_totals(counts, groups, "_down", ["pos", "neg"])
    gain = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    sums = run.groupBy(*groups).agg(F.sum(gain).alias("g"), F.sum("pos").alias("p"))
    return sums.select(*groups, F.when(F.col("p") > 0, F.col("g") / F.col("p")).alias("average_precision"))


def classification_report(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """precision, recall, f1 and support per class plus accuracy, macro and weighted averages."""
    pairs = df.groupBy(F.col(y).cast("string").alias("t"), F.col(p).cast("string").alias("g")).agg(
        F.count(F.lit(1)).alias("n")
    )
    by_true = pairs.groupBy(F.col("t").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0)).alias("hit")
    )
    by_guess = pairs.groupBy(F.col("g").alias("class")).agg(F.sum("n").alias("called"))
    both = by_true.join(by_guess, "class", "full").na.fill(0, ["support", "hit", "called"])
    hit, called, support = (F.col(c).cast("double") for c in ("hit", "called", "support"))
    rows = both.select(
        "class",
        ratio(hit, called).alias("precision"),
        ratio(hit, support).alias("recall"),
        ratio(2 * hit, called + support).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
        F.col("hit").alias("hit"),
    )
    names = ("precision", "recall", "f1")

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    totals = rows.agg(
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[weighted(c).alias(f"w_{c}") for c in names],
        F.sum("support").alias("support"),
        ratio(F.sum("hit"), F.sum("support")).alias("acc"),
    )
    extra = totals.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    F.lit(None).cast("double").alias("precision"),
                    F.lit(None).cast("double").alias("recall"),
                    F.col("acc").alias("f1"),
                    F.col("support").alias("support"),
                ),
                F.struct(
                    F.lit("macro avg").alias("class"),
                    *[F.col(f"m_{c}").alias(c) for c in names],
                    F.col("support").alias("support"),
                ),
                F.struct(
                    F.lit("weighted avg").alias("class"),
                    *[F.col(f"w_{c}").alias(c) for c in names],
                    F.col("support").alias("support"),
                ),
            )
        )
    )
    return rows.drop("hit").unionByName(extra)


def cv_summary(fold_scores: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Mean and population deviation over folds of long scores (groups, metric, value); NaN is left out."""
    value = F.when(~F.isnan("value"), F.col("value"))
    out = fold_scores.groupBy(*groups, "metric").agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    text = F.concat(F.format_string("%.4f", "mean"), F.lit(" (±"), F.format_string("%.3f", "std"), F.lit(")"))
    return out.withColumn("text", F.when(F.col("mean").isNotNull(), text))


def metrics_long(wide: DataFrame, groups: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per (group, metric) from a wide metrics table."""
    parts = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return wide.select(*groups, F.inline(F.array(*parts)))


def comparison_table(summary: DataFrame, models: Sequence[str], model: str = "model", cell: str = "text") -> DataFrame:
    """Metrics as rows, models as columns; the model list is given, so the pivot needs no extra pass."""
    return summary.groupBy("metric").pivot(model, list(models)).agg(F.first(cell, ignorenulls=True))


def comparison_numeric(table: DataFrame, models: Sequence[str]) -> DataFrame:
    """Models as rows, metrics as one number each: the first token of every text cell."""
    parts = [
        F.struct(F.lit(m).alias("model"), F.split(F.col(f"`{m}`"), " ")[0].try_cast("double").alias("value"))
        for m in models
    ]
    return table.select("metric", F.inline(F.array(*parts))).select("model", "metric", "value")


def estimate_confusion(df: DataFrame, n_pos: Column, n_neg: Column, precision: str = "precision", recall: str = "recall") -> DataFrame:
    """Whole-number tn, fp, fn, tp that fit a precision, a recall and the class sizes.

    Half counts round to even; precision 0 means that every negative was called positive.
    """
    prec, rec = F.col(precision), F.col(recall)
    ok = prec.isNotNull() & rec.isNotNull() & ~F.isnan(prec) & ~F.isnan(rec)
    hits = rec * n_pos
    false_calls = F.when(prec > 0, hits * (F.lit(1.0) / F.greatest(prec, F.lit(1e-12)) - 1)).otherwise(n_neg)

    def within(x: Column, top: Column) -> Column:
        return F.greatest(F.lit(0), F.least(x, top)).cast("bigint")

    return (
        df.where(ok)
        .withColumn("tp", within(F.rint(hits), n_pos))
        .withColumn("fn", (n_pos - F.col("tp")).cast("bigint"))
        .withColumn("fp", within(F.rint(false_calls), n_neg))
        .withColumn("tn", (n_neg - F.col("fp")).cast("bigint"))
    )


def estimate_check(df: DataFrame, digits: int = 3) -> DataFrame:
    """Accuracy and F1 implied by the estimated counts, rounded beside the reported figures."""
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    prec, rec = F.col("precision"), F.col("recall")
    return df.withColumn("acc_est", F.round(ratio(F.col("tp") + F.col("tn"), n), digits)).withColumn(
        "f1_est", F.round(2 * prec * rec / (prec + rec + 1e-12), digits)
    )


def best_threshold_rows(df: DataFrame, threshold: float, score: str = "y_prob", name: str = "y_pred") -> DataFrame:
    """Class decision at a chosen probability threshold."""
    return df.withColumn(name, (F.col(score) >= F.lit(threshold)).cast("int"))


def latest(df: DataFrame, groups: Sequence[str], by: str) -> DataFrame:
    """Newest row per group without a window: one aggregation over a struct."""
    others = [c for c in df.columns if c not in groups]
    picked = df.groupBy(*groups).agg(F.max_by(F.struct(*others), F.col(by)).alias("_row"))
    return picked.select(*groups, "_row.*")


