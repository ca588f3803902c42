"""Choosing runs: field parsing, gates, winners per group, overall winner, model family, parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.runtime import attach_small

# Metric names in order of preference.
METRIC_PREFERENCE = (
    "cv_cand_test_roc_auc",
    "cv_cand_test_f1",
    "cv_cand_test_recall",
    "cv_cand_test_precision",
    "cv_cand_test_accuracy",
    "cv_cand_train_roc_auc",
    "cv_cand_train_f1",
    "cv_cand_train_recall",
    "cv_cand_train_precision",
    "cv_cand_train_accuracy",
    "cv_best_test_roc_auc",
    "cv_best_test_f1",
    "cv_best_test_recall",
    "cv_best_test_precision",
    "cv_best_test_accuracy",
    "cv_best_train_roc_auc",
    "cv_best_train_f1",
    "cv_best_train_recall",
    "cv_best_train_precision",
    "cv_best_train_accuracy",
)

# Limits of the over- and under-fitting gates.
MIN_TEST_AUC = 0.70
MIN_TEST_F1 = 0.50
MAX_GAP_AUC = 0.05
MAX_GAP_F1 = 0.06

# Model family of each spelling in run names.
FAMILY_OF = {
    "lr": "lr",
    "logreg": "lr",
    "logistic": "lr",
    "logit": "lr",
    "rf": "rf",
    "randomforest": "rf",
    "mlp": "mlp",
    "nn": "mlp",
    "neural": "mlp",
    "perceptron": "mlp",
    "svc": "svc",
    "svm": "svc",
    "knn": "knn",
    "kneighbors": "knn",
    "dt": "dt",
    "decisiontree": "dt",
    "tree": "dt",
    "xgb": "xgb",
    "xgboost": "xgb",
}

# Beginnings of a token that also name a family.
FAMILY_STARTS = {"logr": "lr", "logi": "lr", "xgb": "xgb", "decis": "dt", "kneigh": "knn"}

# Patterns that recognise a metric by its name.
METRIC_PATTERNS = {
    "precision": "precision",
    "recall": "recall|sensitivity",
    "accuracy": r"accuracy|\bacc(uracy)?\b",
    "roc_auc": r"roc[_-]?auc|\bauc\b",
    "f1": r"f1[_-]?score|\bf1\b",
}
TEST_HINT = r"\btest\b|\bvalid(ation)?\b|\boof\b|\beval\b"
TRAIN_HINT = r"\btrain(ing)?\b|\bfold[_-]?train\b"

# Parameter-name prefixes that pipelines add.
PARAM_PREFIXES = ("model__", "classifier__", "estimator__", "param_")


# ---- fields ----------------------------------------------------------------------------------------


def flag(text: Column) -> Column:
    """Truth of a text tag: true, 1, yes or y in any case; anything else, null included, is false."""
    return F.coalesce(F.lower(F.trim(text)).isin("true", "1", "yes", "y"), F.lit(False))


def rekey(pairs: Column, name) -> Column:
    """Map with renamed keys; of several keys that end up equal the last one counts."""
    entries = F.transform(F.map_entries(pairs), lambda e: F.struct(name(e["key"]).alias("key"), e["value"].alias("value")))

    def last(entries: Column) -> Column:
        names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"]))

    # As the element of a one-element array the entries are a variable; else they would be made anew for every key.
    return F.transform(F.array(entries), last)[0]


def _with_prefix(params: Column, prefix: str) -> Column:
    return F.map_filter(params, lambda k, _: F.startswith(k, F.lit(prefix)))


def chosen_params(params: Column) -> Column:
    """``best::`` entries without their prefix, else ``model__`` entries, else everything."""
    best, model = _with_prefix(params, "best::"), _with_prefix(params, "model__")
    bare = rekey(best, lambda k: F.substr(k, F.lit(len("best::") + 1)))
    return F.when(F.size(best) > 0, bare).when(F.size(model) > 0, model).otherwise(params)


def params_text(params: Column) -> Column:
    """``k=v, k=v`` sorted by key."""
    parts = F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.coalesce(F.concat_ws(", ", parts), F.lit(""))


def preferred_metric(metrics: Column, order: Sequence[str] = METRIC_PREFERENCE) -> Column:
    """Struct (name, value) of the first metric in the list that the run has."""
    picks = [F.when(metrics[m].isNotNull() & ~F.isnan(metrics[m]), F.struct(F.lit(m).alias("name"), metrics[m].alias("value"))) for m in order]
    return F.coalesce(*picks)


def metric_by_keyword(metrics: Column, keyword: str) -> Column:
    """Value of a metric found by keyword: listed names first, then any alias, test before train.

    Within equals the alphabetically first name wins.
    """
    lower = rekey(metrics, F.lower)
    listed = [lower[m] for m in METRIC_PREFERENCE if keyword in m]
    pattern = METRIC_PATTERNS.get(keyword, keyword)
    named = F.filter(
        F.map_entries(lower), lambda e: e["key"].rlike(pattern) & e["value"].isNotNull() & ~F.isnan(e["value"])
    )
    ranked = F.array_sort(
        F.transform(
            named,
            lambda e: F.struct(
                (
                    F.when(e["key"].rlike(TRAIN_HINT), 1).otherwise(0) - F.when(e["key"].rlike(TEST_HINT), 1).otherwise(0)
                ).alias("late"),
                e["key"].alias("key"),
                e["value"].alias("value"),
            ),
        )
    )
    return F.coalesce(*listed, F.get(ranked, F.lit(0))["value"])


def model_family(name: Column, params: Column | None = None) -> Column:
    """Short family key from the tokens of a run name, else from parameter names, else null."""
    words = F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda t: t != "")
    forest = F.array_contains(words, F.lit("forest"))
    spelled = F.create_map(*[F.lit(x) for pair in FAMILY_OF.items() for x in pair])

    def of(t: Column) -> Column:
        starts = [F.when(F.startswith(t, F.lit(s)), F.lit(fam)) for s, fam in FAMILY_STARTS.items()]
        return F.coalesce(spelled[t], *starts, F.when(F.startswith(t, F.lit("rand")) & forest, F.lit("rf")))

    by_name = F.get(F.filter(F.transform(words, of), lambda f: f.isNotNull()), F.lit(0))
    return by_name if params is None else F.coalesce(by_name, family_by_params(params))


def family_by_params(params: Column) -> Column:
    """Family guessed from the parameter names a run has."""
    keys = F.transform(F.map_keys(params), lambda k: F.lower(k))

    def has(*names: str) -> Column:
        return F.arrays_overlap(keys, F.array(*[F.lit(n) for n in names]))

    trees = has("n_estimators")
    boosted = trees & has("learning_rate", "colsample_bytree")
    forest = trees & has("max_features", "min_samples_split", "bootstrap")
    return (
        F.when(boosted, "xgb")
        .when(forest, "rf")
        .when(has("c", "penalty", "solver"), "lr")
        .when(has("kernel", "degree") | (has("gamma") & ~trees), "svc")
        .when(has("hidden_layer_sizes") | (has("alpha") & has("learning_rate_init")), "mlp")
        .when(has("n_neighbors", "weights"), "knn")
        .when(has("criterion", "splitter") | (has("max_depth") & ~trees), "dt")
    )


def registry_key(name: Column, model_class: Column | None = None) -> Column:
    """Short key for registered models by substring of the run name, then of the class name, else ``x``."""
    text = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "__grid", ""), r"[+_\s]+", " ")

    def has(c: Column, *parts: str) -> Column:
        return F.coalesce(c.rlike("|".join(parts)), F.lit(False))

    pick = (
        F.when(has(text, "logreg", "logistic"), "lr")
        .when(has(text, "randomforest", "rf"), "rf")
        .when(has(text, "xgb"), "xgb")
        .when(has(text, "decisiontree", "dt"), "dt")
        .when(has(text, "mlp"), "mlp")
        .when(has(text, "svc", "svm"), "svc")
        .when(has(text, "knn"), "knn")
    )
    if model_class is not None:
        cls = F.lower(model_class)
        pick = (
            pick.when(has(cls, "logisticregression"), "lr")
            .when(has(cls, "randomforest"), "rf")
            .when(has(cls, "xgb"), "xgb")
            .when(has(cls, "decisiontree"), "dt")
            .when(has(cls, "mlp"), "mlp")
            .when(has(cls, "svc"), "svc")
            .when(has(cls, "kneighbors"), "knn")
        )
    return pick.otherwise("x")


def clean_params(params: Column) -> Column:
    """Parameters without search bookkeeping (``x::y``, ``grid_``, ``search_``) and without prefixes."""
    kept = F.map_filter(params, lambda k, _: ~F.contains(k, F.lit("::")) & ~k.rlike("^(grid_|search_)"))

    prefixes = "^" + "".join(f"({p})?" for p in PARAM_PREFIXES)  # each once, in this order

    def bare(k: Column) -> Column:
        return F.regexp_replace(k, prefixes, "")

    return rekey(kept, bare)


def typed_value(text: Column) -> Column:
    """Struct (kind, value) of a text parameter: bool, none, int, float or text, spelled canonically."""
    low = F.lower(F.trim(text))
    whole = F.when(low.rlike(r"^[+-]?\d+$"), low).try_cast("bigint")
    number = F.when(low.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"), low).try_cast("double")

    def make(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    return (
        F.when(low.isin("true", "yes"), make("bool", F.lit("true")))
        .when(low.isin("false", "no"), make("bool", F.lit("false")))
        .when(low.isin("none", "null"), make("none", F.lit(None).cast("string")))
        .when(whole.isNotNull(), make("int", whole.cast("string")))
        .when(number.isNotNull(), make("float", number.cast("string")))
        .otherwise(make("text", text))
    )


def typed_params(params: Column) -> Column:
    return F.transform_values(clean_params(params), lambda _, v: typed_value(v))


# ---- gates and winners -----------------------------------------------------------------------------


def with_gates(
    df: DataFrame,
    train_auc: str = "mean_train_roc_auc",
    test_auc: str = "mean_test_roc_auc",
    train_f1: str = "mean_train_f1",
    test_f1: str = "mean_test_f1",
    min_auc: float = MIN_TEST_AUC,
    min_f1: float = MIN_TEST_F1,
    max_gap_auc: float = MAX_GAP_AUC,
    max_gap_f1: float = MAX_GAP_F1,
) -> DataFrame:
    """Under-fit, over-fit and pass flags of cross-validated candidates."""
    a_train, a_test, f_train, f_test = (F.col(c) for c in (train_auc, test_auc, train_f1, test_f1))
    gap_auc, gap_f1 = F.abs(a_train - a_test), F.abs(f_train - f_test)
    under = ((a_test < min_auc) & (a_train < min_auc)) | ((f_test < min_f1) & (f_train < min_f1))
    over = (gap_auc > max_gap_auc) | (gap_f1 > max_gap_f1)
    good = ~under & ~over & (a_test >= min_auc) & (f_test >= min_f1)
    return df.withColumns(
        {
            "gate_gap_auc": gap_auc,
            "gate_gap_f1": gap_f1,
            "gate_underfit": under,
            "gate_overfit": over,
            "gate_passes": F.coalesce(good, F.lit(False)),
        }
    )


def best_passing(
    df: DataFrame, group: str, auc: str = "mean_test_roc_auc", f1: str = "mean_test_f1", tie: str = "candidate"
) -> DataFrame:
    """Per group the passing candidate with the highest AUC; AUCs within 1e-9 are decided by F1, then by id.

    Two aggregations with map-side combine instead of a window over a possibly hot group.
    """
    ok = df.where("gate_passes")
    top = ok.groupBy(group).agg(F.max(auc).alias("_top"))
    near = ok.join(top, group).where(F.col(auc) > F.col("_top") - 1e-9)
    rest = [c for c in df.columns if c != group]
    picked = near.groupBy(group).agg(F.max_by(F.struct(*rest), F.struct(F.col(f1), -F.col(tie))).alias("_w"))
    return picked.select(group, "_w.*")


def name_children(runs: DataFrame, whitelist: Sequence[str] | None = None) -> DataFrame:
    """Child runs with their parent's name and parsed gate flag; children of unlisted parents are left out.

    Parents are the runs without a parent. Where they were counted as few they are broadcast: a parent may have very many children.
    """
    parents = runs.where(F.col("parent_id").isNull()).select(
        F.col("run_id").alias("parent_id"), F.col("run_name").alias("parent_name")
    )
    if whitelist is not None:
        parents = parents.where(F.col("parent_name").isin(list(whitelist)))
    gate = F.coalesce(F.col("tags")["gate_passes"], F.col("tags")["get_gates"])
    children = runs.where(F.col("parent_id").isNotNull()).withColumn("gate_passes", flag(gate))
    return attach_small(children, parents, ["parent_id"], "inner")


def winners(children: DataFrame, order: Sequence[str] = METRIC_PREFERENCE) -> DataFrame:
    """Per parent name the passing child with the best value of the first preferred metric any of them has."""
    ok = children.where("gate_passes")
    for i, m in enumerate(order):
        value = F.col("metrics")[m]
        ok = ok.withColumn(f"_m{i}", F.when(~F.isnan(value), value))
    # Numbers first: a whole row as an aggregate would have all rows sorted, with their maps, in the tasks that read them.
    tops = ok.groupBy("parent_name").agg(*[F.max(f"_m{i}").alias(f"_t{i}") for i in range(len(order))])
    first = F.coalesce(*[F.when(F.col(f"_t{i}").isNotNull(), F.lit(i)) for i in range(len(order))])
    tops = tops.select("parent_name", first.alias("_first"), F.coalesce(*[F.col(f"_t{i}") for i in range(len(order))], F.lit(float("-inf"))).alias("_top"))
    ok = attach_small(ok, tops, ["parent_name"], "inner")
    value = F.get(F.array(*[F.col(f"_m{i}") for i in range(len(order))]), F.col("_first"))
    name = F.get(F.array(*[F.lit(m) for m in order]), F.col("_first"))
    ok = ok.withColumn("metric_value", value).withColumn("chosen_metric", name)
    ok = ok.where(F.coalesce(F.col("metric_value"), F.lit(float("-inf"))) == F.col("_top"))
    # among equal values the smallest run id wins
    ids = ok.groupBy("parent_name").agg(F.min(F.struct("run_id")).alias("_id"))
    ok = attach_small(ok, ids, ["parent_name"], "inner").where(F.col("run_id").eqNullSafe(F.col("_id.run_id")))
    row = F.struct("run_id", "chosen_metric", "metric_value", "params", "metrics")
    best = ok.groupBy("parent_name").agg(F.min_by(row, F.struct("run_id")).alias("w"))
    return best.select(
        "parent_name",
        F.col("w.run_id").alias("child_run_id"),
        F.col("w.chosen_metric").alias("chosen_metric"),
        F.col("w.metric_value").alias("metric_value"),
        chosen_params(F.col("w.params")).alias("best_params"),
        params_text(chosen_params(F.col("w.params"))).alias("best_params_str"),
        F.col("w.metrics").alias("metrics"),
    )


def sort_winners(table: DataFrame) -> DataFrame:
    return table.orderBy(F.col("chosen_metric").asc_nulls_last(), F.col("metric_value").desc_nulls_last(), "parent_name")


def failed_groups(children: DataFrame) -> DataFrame:
    """Parents none of whose children passed, with the parameters of their best failing child."""
    flagged = children.withColumn("_p", preferred_metric(F.col("metrics")))
    sums = flagged.groupBy("parent_name").agg(
        F.max("gate_passes").alias("any_pass"),
        F.count(F.lit(1)).alias("children"),
        F.min_by(
            F.when(F.col("_p").isNotNull(), params_text(chosen_params(F.col("params")))),
            F.struct(-F.coalesce(F.col("_p.value"), F.lit(float("-inf"))), F.col("run_id")),
        ).alias("example"),
    )
    text = F.concat(
        F.col("parent_name"), F.lit(": all children failed gates (under/overfit). Example params: "), F.coalesce("example", F.lit(""))
    )
    return sums.where(~F.col("any_pass")).select("parent_name", "children", text.alias("message"))


def overall_winner(table: DataFrame, order: Sequence[str] = METRIC_PREFERENCE) -> DataFrame:
    """One row: the winner by the first preferred metric that any winner has, else by its chosen metric.

    The table has one row per model group, so a top-1 sort is a map-side maximum.
    """
    value = {m: F.col("metrics")[m] for m in order}
    seen = table.agg(*[F.count(value[m]).alias(f"c{i}") for i, m in enumerate(order)]).first()
    by = next((m for i, m in enumerate(order) if seen[f"c{i}"]), None)
    sort = value[by] if by else F.col("metric_value")
    return (
        table.withColumn("by_metric", F.lit(by) if by else F.col("chosen_metric"))
        .withColumn("by_value", sort)
        .orderBy(F.col("by_value").desc_nulls_last(), "parent_name")
        .limit(1)
    )


def pick_best_row(table: DataFrame) -> DataFrame:
    """Best row of a model table: by ``metric_value`` if it is there, else by AUC > F1 > accuracy > precision > recall;
    equal ones by the rows' JSON text."""
    if "metric_value" in table.columns:
        return table.orderBy(F.col("metric_value").desc_nulls_last(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]))).limit(1)
    lower = {c.lower(): c for c in table.columns}
    for m in ("roc_auc", "f1", "accuracy", "precision", "recall"):
        for name in (f"cv_cand_test_{m}", m, "auc" if m == "roc_auc" else m):
            if name in lower:
                return table.orderBy(F.col(lower[name]).desc_nulls_last(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]))).limit(1)
    return table.limit(1)


def best_run(runs: DataFrame, metric: str) -> DataFrame:
    """The run with the highest value of a metric; runs without it do not count."""
    value = F.col("metrics")[metric]
    return runs.where(value.isNotNull()).orderBy(value.desc(), "run_id").limit(1)


def champion(runs: DataFrame, metric: str):
    """Name of the champion's model; no run with the metric is an error."""
    rows = best_run(runs, metric).collect()
    if not rows:
        raise ValueError(f"no run has the metric {metric}")
    return rows[0]


def top_per_group(df: DataFrame, group: str, value: str, n: int, tie: str) -> DataFrame:
    """The n best rows per group; Spark keeps only n rows per task and group before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last(), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
