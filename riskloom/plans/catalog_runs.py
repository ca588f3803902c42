"""Queries for gates, run selection and run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import select as sel
from riskloom.plans import data, jobs
from riskloom.plans.catalog_profile import rounded
from riskloom.plans.registry import query
from riskloom.runtime import scratch_path
from riskloom.sources import runs as run_store

GATED = f"""c AS ({data.RUNS_SQL}), g AS (SELECT *, abs(mean_train_roc_auc - mean_test_roc_auc) AS ga, abs(mean_train_f1 - mean_test_f1) AS gf,
  (mean_test_roc_auc < 0.70e0 AND mean_train_roc_auc < 0.70e0) OR (mean_test_f1 < 0.50e0 AND mean_train_f1 < 0.50e0) AS under FROM c),
h AS (SELECT *, ga > 0.05e0 OR gf > 0.06e0 AS over FROM g),
k AS (SELECT *, NOT under AND NOT over AND mean_test_roc_auc >= 0.70e0 AND mean_test_f1 >= 0.50e0 AS pass FROM h)"""
LISTED = ", ".join(f"'{n}'" for n in data.RUN_NAMES)


@query(
    "fit_gates",
    f"WITH {GATED} SELECT candidate, round(ga, 8) AS gate_gap_auc, round(gf, 8) AS gate_gap_f1, under AS gate_underfit, over AS gate_overfit, pass AS gate_passes FROM k",
)
def fit_gates(spark, d):
    df = sel.with_gates(data.candidates(spark, d))
    cols = ["candidate", "gate_gap_auc", "gate_gap_f1", "gate_underfit", "gate_overfit", "gate_passes"]
    return rounded(df.select(*cols), ["gate_gap_auc", "gate_gap_f1"], 8)


@query(
    "best_passing_candidate",
    f"""WITH {GATED}, t AS (SELECT parent_name, max(mean_test_roc_auc) AS top FROM k WHERE pass GROUP BY parent_name)
    SELECT parent_name, candidate, round(mean_test_roc_auc, 8) AS auc, round(mean_test_f1, 8) AS f1 FROM (
      SELECT k.*, row_number() OVER (PARTITION BY k.parent_name ORDER BY mean_test_f1 DESC, candidate) AS i
      FROM k JOIN t ON k.parent_name = t.parent_name WHERE pass AND mean_test_roc_auc > top - 1e-9) WHERE i = 1""",
)
def best_passing_candidate(spark, d):
    df = sel.best_passing(sel.with_gates(data.candidates(spark, d)), "parent_name")
    return df.select("parent_name", "candidate", F.round("mean_test_roc_auc", 8).alias("auc"), F.round("mean_test_f1", 8).alias("f1"))


@query(
    "children_with_parents",
    f"WITH {GATED} SELECT run_id, parent_name, pass AS gate_passes FROM k WHERE parent_name IN ({LISTED})",
)
def children_with_parents(spark, d):
    return sel.name_children(data.run_records(spark, d), data.RUN_NAMES).select("run_id", "parent_name", "gate_passes")


WINNERS = f"""WITH {GATED}, w AS (SELECT *, row_number() OVER (PARTITION BY parent_name ORDER BY mean_test_roc_auc DESC, run_id) AS i FROM k
  WHERE pass AND parent_name IN ({LISTED}))"""


@query(
    "group_winners",
    WINNERS + """ SELECT parent_name, run_id AS child_run_id, 'cv_cand_test_roc_auc' AS chosen_metric, round(mean_test_roc_auc, 8) AS metric_value,
    'model__C=' || c || ', model__max_depth=' || depth AS best_params_str, c AS best_c, depth AS best_max_depth, 2 AS n_params, 6 AS n_metrics,
    round(mean_test_roc_auc, 8) AS cv_cand_test_roc_auc, round(mean_train_roc_auc, 8) AS cv_cand_train_roc_auc, round(mean_test_f1, 8) AS cv_cand_test_f1,
    round(mean_train_f1, 8) AS cv_cand_train_f1, round(mean_test_precision, 8) AS cv_cand_test_precision, round(mean_test_recall, 8) AS cv_cand_test_recall
    FROM w WHERE i = 1""",
)
def group_winners(spark, d):
    out = jobs.select_job(data.run_records(spark, d), data.RUN_NAMES)["winners"]
    params = [F.col("best_params")["model__C"].alias("best_c"), F.col("best_params")["model__max_depth"].alias("best_max_depth"), F.size("best_params").alias("n_params")]
    names = ["cv_cand_test_roc_auc", "cv_cand_train_roc_auc", "cv_cand_test_f1", "cv_cand_train_f1", "cv_cand_test_precision", "cv_cand_test_recall"]
    metrics = [F.col("metrics")[n].alias(n) for n in names]
    shown = out.select(*[c for c in out.columns if c not in ("best_params", "metrics")], *params, F.size("metrics").alias("n_metrics"), *metrics)
    return rounded(shown, ["metric_value", *names], 8)


@query(
    "failed_groups",
    f"""WITH {GATED}, f AS (SELECT parent_name, count(*) AS children FROM k WHERE parent_name IN ({LISTED}) GROUP BY parent_name HAVING NOT bool_or(pass)),
    e AS (SELECT k.*, row_number() OVER (PARTITION BY parent_name ORDER BY mean_test_roc_auc DESC, run_id) AS i FROM k)
    SELECT f.parent_name, children, f.parent_name || ': all children failed gates (under/overfit). Example params: model__C=' || c || ', model__max_depth=' || depth AS message
    FROM f JOIN e ON f.parent_name = e.parent_name WHERE i = 1""",
)
def failed_groups(spark, d):
    return sel.failed_groups(sel.name_children(data.run_records(spark, d), data.RUN_NAMES))


@query(
    "overall_winner",
    WINNERS + " SELECT parent_name, run_id AS child_run_id, 'cv_cand_test_roc_auc' AS by_metric, round(mean_test_roc_auc, 8) AS by_value "
    "FROM w WHERE i = 1 ORDER BY mean_test_roc_auc DESC, parent_name LIMIT 1",
)
def overall_winner(spark, d):
    out = jobs.select_job(data.run_records(spark, d), data.RUN_NAMES)["overall"]
    return rounded(out.select("parent_name", "child_run_id", "by_metric", "by_value"), ["by_value"], 8)


@query(
    "best_run",
    f"WITH c AS ({data.RUNS_SQL}) SELECT run_id, round(mean_test_f1, 8) AS f1 FROM c ORDER BY mean_test_f1 DESC, run_id LIMIT 1",
)
def best_run(spark, d):
    out = sel.best_run(data.run_records(spark, d), "cv_cand_test_f1")
    return out.select("run_id", F.round(F.col("metrics")["cv_cand_test_f1"], 8).alias("f1"))


@query(
    "pick_best_row",
    f"WITH c AS ({data.RUNS_SQL}) SELECT run_id, round(mean_test_roc_auc, 8) AS roc_auc, round(mean_test_f1, 8) AS f1 FROM c ORDER BY mean_test_roc_auc DESC, run_id LIMIT 1",
)
def pick_best_row(spark, d):
    df = data.candidates(spark, d).select("run_id", F.col("mean_test_roc_auc").alias("roc_auc"), F.col("mean_test_f1").alias("f1"))
    return rounded(sel.pick_best_row(df), ["roc_auc", "f1"], 8)


@query(
    "top_runs_per_group",
    f"""WITH c AS ({data.RUNS_SQL}) SELECT parent_name, run_id, rank FROM (SELECT parent_name, run_id,
    row_number() OVER (PARTITION BY parent_name ORDER BY mean_test_recall DESC, run_id) AS rank FROM c) WHERE rank <= 3""",
)
def top_runs_per_group(spark, d):
    return sel.top_per_group(data.candidates(spark, d), "parent_name", "mean_test_recall", 3, "run_id").select("parent_name", "run_id", "rank")


@query(
    "metric_by_keyword",
    f"""WITH c AS ({data.RUNS_SQL}) SELECT run_id, round(mean_test_precision, 8) AS precision_used, round(mean_test_recall, 8) AS recall_used,
    round(mean_test_roc_auc, 8) AS auc_used, round(mean_test_f1, 8) AS f1_used, NULL::DOUBLE AS accuracy_used FROM c""",
)
def metric_by_keyword(spark, d):
    runs = data.run_records(spark, d).where("parent_id IS NOT NULL")
    m = F.col("metrics")
    names = {"precision_used": "precision", "recall_used": "recall", "auc_used": "roc_auc", "f1_used": "f1", "accuracy_used": "accuracy"}
    return runs.select("run_id", *[F.round(sel.metric_by_keyword(m, k), 8).alias(n) for n, k in names.items()])


@query(
    "preferred_metric",
    f"""WITH c AS ({data.RUNS_SQL}) SELECT run_id, CASE WHEN candidate % 3 = 0 THEN 'cv_cand_test_roc_auc' ELSE 'cv_cand_train_f1' END AS name,
    round(CASE WHEN candidate % 3 = 0 THEN mean_test_roc_auc ELSE mean_train_f1 END, 8) AS value FROM c""",
)
def preferred_metric(spark, d):
    has = F.col("candidate") % 3 == 0
    metrics = F.create_map(
        F.lit("cv_cand_train_f1"), "mean_train_f1", F.lit("cv_cand_test_roc_auc"), F.when(has, F.col("mean_test_roc_auc"))
    )
    df = data.candidates(spark, d).select("run_id", sel.preferred_metric(metrics).alias("p"))
    return df.select("run_id", F.col("p.name").alias("name"), F.round("p.value", 8).alias("value"))


FAMILY_CASE = "CASE o_custkey % 7 WHEN 0 THEN 'rf' WHEN 1 THEN 'dt' WHEN 2 THEN 'mlp' WHEN 3 THEN 'svc' WHEN 4 THEN 'knn' WHEN 5 THEN 'lr' ELSE 'xgb' END"


@query(
    "model_family",
    f"SELECT o_orderkey, {FAMILY_CASE} AS family, CASE WHEN o_custkey % 7 = 6 THEN 'x' ELSE {FAMILY_CASE} END AS registry FROM orders",
)
def model_family(spark, d):
    df = data._frame(spark, d, "orders", {"o_orderkey": "o_orderkey", **{k: data.RUNS[k] for k in ("parent_name", "depth")}})
    params = F.create_map(F.lit("n_estimators"), F.lit("10"), F.lit("learning_rate"), F.col("depth"))
    name = F.col("parent_name")
    return df.select("o_orderkey", sel.model_family(name, params).alias("family"), sel.registry_key(name).alias("registry"))


@query(
    "family_by_params",
    """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'xgb' WHEN 1 THEN 'rf' WHEN 2 THEN 'lr' WHEN 3 THEN 'svc' WHEN 4 THEN 'mlp'
    WHEN 5 THEN 'knn' WHEN 6 THEN 'dt' END AS family FROM orders""",
)
def family_by_params(spark, d):
    names = [
        ("n_estimators", "learning_rate"), ("n_estimators", "max_features"), ("C", "solver"), ("kernel", "gamma"),
        ("alpha", "learning_rate_init"), ("n_neighbors", "p"), ("max_depth", "ccp_alpha"), ("verbose", "n_jobs"),
    ]
    pick = F.get(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in names]), (F.col("o_orderkey") % 8).cast("int"))
    params = F.map_from_arrays(pick, F.array(F.lit("1"), F.lit("2")))
    return data.read(spark, d, "orders").select("o_orderkey", sel.family_by_params(params).alias("family"))


@query(
    "clean_run_params",
    """SELECT o_orderkey, 'C=float:0.5, max_depth=int:' || (o_custkey % 9) || ', penalty=text:l2, random_state=none:, shuffle=bool:' ||
    CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS params FROM orders""",
)
def clean_run_params(spark, d):
    df = data.read(spark, d, "orders")
    params = F.create_map(
        F.lit("model__C"), F.lit("0.50"),
        F.lit("param_max_depth"), (F.col("o_custkey") % 9).cast("string"),
        F.lit("classifier__penalty"), F.lit("l2"),
        F.lit("random_state"), F.lit("None"),
        F.lit("model__shuffle"), F.when(F.col("o_orderkey") % 2 == 0, "True").otherwise("False"),
        F.lit("cand::model__C"), F.lit("9"),
        F.lit("grid_model__C"), F.lit("[1, 2]"),
    )
    cleaned = sel.typed_params(params)
    cells = F.transform_values(cleaned, lambda _, v: F.concat(v["kind"], F.lit(":"), F.coalesce(v["value"], F.lit(""))))
    return df.select("o_orderkey", sel.params_text(cells).alias("params"))


@query(
    "run_field_parsing",
    f"""WITH {GATED} SELECT run_id, pass AS gate_passes, 'model__C=' || c || ', model__max_depth=' || depth AS params FROM k""",
)
def run_field_parsing(spark, d):
    df = data.run_records(spark, d).where("parent_id IS NOT NULL")
    return df.select(
        "run_id",
        sel.flag(F.col("tags")["gate_passes"]).alias("gate_passes"),
        sel.params_text(sel.chosen_params(F.col("params"))).alias("params"),
    )


@query(
    "safe_names",
    f"WITH c AS ({data.RUNS_SQL}) SELECT replace(parent_name, ' + ', '-').replace(' ', '-') AS name, count(*) AS n FROM c GROUP BY 1",
)
def safe_names(spark, d):
    from riskloom.functions.text import safe_name

    df = data.candidates(spark, d).select(safe_name(F.col("parent_name")).alias("name"))
    return df.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "run_log_scan",
    f"""WITH c AS ({data.RUNS_SQL}) SELECT parent_id, count(*) AS runs, round(max(mean_test_f1), 8) AS best_f1 FROM c GROUP BY parent_id
    UNION ALL SELECT NULL, count(DISTINCT parent_id), NULL FROM c""",
)
def run_log_scan(spark, d):
    path = scratch_path(spark, "runs")
    records = data.run_records(spark, d).withColumn("ts", F.current_timestamp())
    records.write.mode("append").parquet(path)
    stored = run_store.read_runs(spark, path)
    return stored.groupBy("parent_id").agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.max(F.col("metrics")["cv_cand_test_f1"]), 8).alias("best_f1")
    )


@query(
    "model_versions",
    f"""WITH c AS ({data.RUNS_SQL}) SELECT parent_name AS name, max(candidate) AS version FROM c GROUP BY parent_name""",
)
def model_versions(spark, d):
    df = data.candidates(spark, d).select(
        F.col("parent_name").alias("name"), F.col("candidate").alias("version"), "run_id",
        F.lit("best").alias("alias"), F.lit("Staging").alias("stage"),
    )
    return run_store.by_alias(df).select("name", "version")
