"""Queries for classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import metrics as m
from riskloom.plans import data
from riskloom.plans.catalog_profile import rounded
from riskloom.plans.registry import query

S = f"WITH s AS ({data.SCORED_SQL})"
CELLS = """count(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 END) AS tn, count(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 END) AS fp,
count(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 END) AS fn, count(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 END) AS tp"""
RATES = """(tp + tn) / (tp + tn + fp + fn)::DOUBLE AS accuracy, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1,
sqrt((tp / (tp + fn)::DOUBLE) * (tn / (tn + fp)::DOUBLE)) AS gmean"""
RATE_NAMES = ["accuracy", "precision", "recall", "f1", "gmean"]


def auc_sql(groups: str) -> str:
    """Mann-Whitney area by average ranks."""
    part = f"PARTITION BY {groups}" if groups else ""
    sel = f"{groups}, " if groups else ""
    return f"""SELECT {sel}(sum(CASE WHEN y_true = 1 THEN rk END) - count(CASE WHEN y_true = 1 THEN 1 END) * (count(CASE WHEN y_true = 1 THEN 1 END) + 1) / 2.0e0)
      / (count(CASE WHEN y_true = 1 THEN 1 END) * count(CASE WHEN y_true = 0 THEN 1 END)::DOUBLE) AS roc_auc
    FROM (SELECT *, rank() OVER ({part} ORDER BY y_prob) + (count(*) OVER (PARTITION BY {sel}y_prob) - 1) / 2.0e0 AS rk FROM s)
    {('GROUP BY ' + groups) if groups else ''}"""


@query("confusion_matrix", f"{S} SELECT phase, {CELLS} FROM s GROUP BY phase")
def confusion_matrix(spark, d):
    return m.confusion(data.scored(spark, d), ["phase"])


@query(
    "confusion_nested",
    f"{S}, c AS (SELECT {CELLS} FROM s) SELECT '[[' || tn || ',' || fp || '],[' || fn || ',' || tp || ']]' AS confusion_matrix FROM c",
)
def confusion_nested(spark, d):
    return m.confusion_matrix(data.scored(spark, d)).select(F.to_json("confusion_matrix").alias("confusion_matrix"))


@query(
    "classification_metrics",
    f"{S}, c AS (SELECT {CELLS} FROM s), r AS (SELECT *, {RATES} FROM c), a AS ({auc_sql('')}) "
    f"SELECT tn, fp, fn, tp, {', '.join(f'round({x}, 8) AS {x}' for x in RATE_NAMES)}, round(roc_auc, 8) AS roc_auc FROM r, a",
)
def classification_metrics(spark, d):
    return rounded(m.classification_metrics(data.scored(spark, d)), RATE_NAMES + ["roc_auc"], 8)


@query(
    "metrics_by_phase",
    f"{S}, c AS (SELECT phase, {CELLS} FROM s GROUP BY phase), r AS (SELECT *, {RATES} FROM c), a AS ({auc_sql('phase')}) "
    f"SELECT r.phase, tn, fp, fn, tp, {', '.join(f'round({x}, 8) AS {x}' for x in RATE_NAMES)}, round(roc_auc, 8) AS roc_auc "
    f"FROM r JOIN a ON r.phase = a.phase",
)
def metrics_by_phase(spark, d):
    return rounded(m.evaluate_phases(data.scored(spark, d)), RATE_NAMES + ["roc_auc"], 8)


@query("gmean_by_fold", f"{S}, c AS (SELECT fold, {CELLS} FROM s GROUP BY fold), r AS (SELECT *, {RATES} FROM c) SELECT fold, round(gmean, 8) AS gmean FROM r")
def gmean_by_fold(spark, d):
    return rounded(m.classification_metrics(data.scored(spark, d), ["fold"], score=None).select("fold", "gmean"), ["gmean"], 8)


@query("roc_auc_by_fold", f"{S}, a AS ({auc_sql('fold')}) SELECT fold, round(roc_auc, 8) AS roc_auc FROM a")
def roc_auc_by_fold(spark, d):
    return rounded(m.roc_auc(data.scored(spark, d), ["fold"]), ["roc_auc"], 8)


CURVE = f"""{S}, g AS (SELECT y_prob AS threshold, sum(y_true) AS p, sum(1 - y_true) AS n FROM s GROUP BY y_prob),
c AS (SELECT threshold, p, n, sum(p) OVER (ORDER BY threshold DESC) AS tp, sum(n) OVER (ORDER BY threshold DESC) AS fp,
             sum(p) OVER () AS ap, sum(n) OVER () AS an FROM g)"""


@query(
    "roc_curve",
    CURVE + " SELECT round(threshold, 8) AS threshold, round(fp / an::DOUBLE, 8) AS fpr, round(tp / ap::DOUBLE, 8) AS tpr FROM c",
)
def roc_curve(spark, d):
    return rounded(m.roc_curve(data.scored(spark, d)), ["threshold", "fpr", "tpr"], 8)


@query("average_precision", CURVE + " SELECT round(sum(p * tp / (tp + fp)::DOUBLE) / max(ap), 8) AS average_precision FROM c")
def average_precision(spark, d):
    return rounded(m.average_precision(data.scored(spark, d)), ["average_precision"], 8)


@query(
    "classification_report",
    f"""{S}, k AS (SELECT y_true AS c FROM s UNION SELECT y_pred FROM s),
    r AS (SELECT CAST(c AS VARCHAR) AS class, count(CASE WHEN y_true = c AND y_pred = c THEN 1 END) AS hit,
                 count(CASE WHEN y_pred = c THEN 1 END) AS called, count(CASE WHEN y_true = c THEN 1 END) AS support FROM s, k GROUP BY c),
    p AS (SELECT class, coalesce(hit / nullif(called, 0)::DOUBLE, 0) AS precision, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS recall,
                 2 * hit / (called + support)::DOUBLE AS f1, support, hit FROM r),
    u AS (SELECT class, precision, recall, f1, support FROM p
      UNION ALL SELECT 'accuracy', NULL, NULL, sum(hit) / sum(support)::DOUBLE, sum(support) FROM p
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM p
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM p)
    SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support::BIGINT AS support FROM u""",
)
def classification_report(spark, d):
    return rounded(m.classification_report(data.scored(spark, d)), ["precision", "recall", "f1"], 8)


FOLD_LONG = f"""{S}, c AS (SELECT phase, fold, {CELLS} FROM s GROUP BY phase, fold), r AS (SELECT *, {RATES} FROM c),
l AS (UNPIVOT (SELECT phase, fold, accuracy, precision, recall, f1, gmean FROM r) ON accuracy, precision, recall, f1, gmean INTO NAME metric VALUE v),
z AS (SELECT phase, metric, avg(v) AS mean, stddev_pop(v) AS std FROM l GROUP BY phase, metric)"""


def _fold_summary(spark, d):
    folds = m.classification_metrics(data.scored(spark, d), ["phase", "fold"], score=None)
    return m.cv_summary(m.metrics_long(folds, ["phase"], RATE_NAMES), ["phase"])


@query("cv_summary", FOLD_LONG + " SELECT phase, metric, round(mean, 8) AS mean, round(std, 8) AS std FROM z")
def cv_summary(spark, d):
    return rounded(_fold_summary(spark, d).drop("text"), ["mean", "std"], 8)


PHASES = ["train", "val", "test"]


@query(
    "model_comparison",
    FOLD_LONG
    + """, t AS (SELECT metric, phase, printf('%.4f (±%.3f)', mean, std) AS cell FROM z)
    SELECT metric, max(CASE WHEN phase = 'train' THEN cell END) AS train, max(CASE WHEN phase = 'val' THEN cell END) AS val,
           max(CASE WHEN phase = 'test' THEN cell END) AS test FROM t GROUP BY metric""",
)
def model_comparison(spark, d):
    return m.comparison_table(_fold_summary(spark, d), PHASES, model="phase")


@query(
    "model_comparison_numbers",
    FOLD_LONG + " SELECT phase AS model, metric, CAST(printf('%.4f', mean) AS DOUBLE) AS value FROM z",
)
def model_comparison_numbers(spark, d):
    return m.comparison_numeric(m.comparison_table(_fold_summary(spark, d), PHASES, model="phase"), PHASES)


ESTIMATE = f"""WITH c AS ({data.RUNS_SQL}), a AS ({data.ACCOUNTS_SQL}), n AS (SELECT sum(y)::BIGINT AS n_pos, sum(1 - y)::BIGINT AS n_neg FROM a),
e AS (SELECT candidate, mean_test_precision AS p, mean_test_recall AS r, n_pos, n_neg, mean_test_recall * n_pos AS hits,
  CASE WHEN mean_test_precision > 0 THEN mean_test_recall * n_pos * (1e0 / greatest(mean_test_precision, 1e-12) - 1) ELSE n_neg END AS calls FROM c, n),
x AS (SELECT candidate, p, r, n_pos, n_neg, greatest(0, least(round_even(hits, 0), n_pos))::BIGINT AS tp,
  greatest(0, least(round_even(calls, 0), n_neg))::BIGINT AS fp FROM e)"""


def _estimated(spark, d):
    acc = data.accounts(spark, d)
    sizes = acc.agg(F.sum("y").cast("bigint").alias("n_pos"), F.sum(1 - F.col("y")).cast("bigint").alias("n_neg")).first()
    cand = data.candidates(spark, d).select(
        "candidate", F.col("mean_test_precision").alias("precision"), F.col("mean_test_recall").alias("recall")
    )
    return m.estimate_confusion(cand, F.lit(sizes["n_pos"]), F.lit(sizes["n_neg"]))


@query("estimated_confusion", ESTIMATE + " SELECT candidate, n_neg - fp AS tn, fp, n_pos - tp AS fn, tp FROM x")
def estimated_confusion(spark, d):
    return _estimated(spark, d).select("candidate", "tn", "fp", "fn", "tp")


@query(
    "estimate_check",
    ESTIMATE + " SELECT candidate, round((tp + n_neg - fp) / (n_pos + n_neg)::DOUBLE, 6) AS acc_est, "
    "round(2 * p * r / (p + r + 1e-12), 6) AS f1_est FROM x",
)
def estimate_check(spark, d):
    return m.estimate_check(_estimated(spark, d), 6).select("candidate", "acc_est", "f1_est")


@query(
    "threshold_decision",
    f"{S}, t AS (SELECT y_true, CASE WHEN y_prob >= 0.15e0 THEN 1 ELSE 0 END AS y_pred FROM s) SELECT {CELLS} FROM t",
)
def threshold_decision(spark, d):
    return m.confusion(m.best_threshold_rows(data.scored(spark, d), 0.15))
