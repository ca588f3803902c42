"""Grown trees beside SQL that grows the same trees one level per block of common table expressions."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import models, trees
from riskloom.operators.metrics import classification_metrics
from riskloom.plans import data
from riskloom.plans.registry import query
from riskloom.runtime import materialize

BINS = 32
FEATURES = ["coalesce(amount, 0e0)", "term", "coalesce(grade, 0e0)", "CASE status WHEN 'F' THEN 0e0 WHEN 'O' THEN 1e0 ELSE 2e0 END"]
#: Features of more than 32 values are cut at their quantiles, the others between their values.
CONTINUOUS = (0, 1)


def tree_rows(spark, d):
    """(key, features, label) of the accounts, features as plain numbers."""
    df = data.accounts(spark, d).selectExpr("CAST(row_id AS STRING) AS key", "y AS label", *[f"{e} AS f{j}" for j, e in enumerate(FEATURES)])
    made = VectorAssembler(inputCols=[f"f{j}" for j in range(len(FEATURES))], outputCol="features").transform(df)
    return materialize(made.select("key", "features", "label"), "treerows")


def _loss(a: str, b: str, rules: trees.Rules) -> str:
    if rules.criterion == "gini":
        return f"2 * {a} * {b} / nullif({a} + {b}, 0)"
    return f"-power(sign({a}) * greatest(abs({a}) - {rules.reg_alpha}, 0), 2) / ({b} + {rules.reg_lambda})"


def grown_sql(rules: trees.Rules, depth: int, first: str, second: str) -> str:
    """Common table expressions up to ``nodes`` (path, depth, n, a, b, feature, bin, gain) of a tree of ``depth`` levels below the root.

    ``first`` and ``second`` are the two sums of a row (class weights, or gradient and hessian) as expressions of y.
    """
    ctes = [f"acc AS ({data.ACCOUNTS_SQL})", f"x AS (SELECT y, {', '.join(f'{e} AS f{j}' for j, e in enumerate(FEATURES))}, {first} AS a, {second} AS b FROM acc)"]
    shares = ", ".join(f"{i / BINS!r}" for i in range(1, BINS))
    for j in range(len(FEATURES)):
        if j in CONTINUOUS:
            ctes.append(f"e{j} AS (SELECT list_sort(list_distinct(quantile_cont(f{j}, [{shares}]))) AS e FROM x)")
        else:
            ctes.append(f"e{j} AS (SELECT list(m ORDER BY m) FILTER (m IS NOT NULL) AS e FROM (SELECT (v + lead(v) OVER (ORDER BY v)) / 2 AS m FROM (SELECT DISTINCT f{j} AS v FROM x)))")
    cells = ", ".join(f"len(list_filter(e{j}.e, lambda z: z < f{j}))" for j in range(len(FEATURES)))
    ctes.append(f"r0 AS (SELECT y, a, b, [{cells}] AS bins, '' AS path FROM x, {', '.join(f'e{j}' for j in range(len(FEATURES)))})")
    rest = {c: f"({c}t - {c}l)" for c in "nab"}
    gain = f"{_loss('at_', 'bt', rules)} - {_loss('al', 'bl', rules)} - {_loss(rest['a'].replace('at', 'at_'), rest['b'], rules)}"
    size = f"(bt + {rules.reg_lambda})" if rules.criterion == "second_order" else "(at_ + bt)"
    fair = f"nl >= {rules.min_samples_leaf} AND nt - nl >= {rules.min_samples_leaf} AND nt >= {max(rules.min_samples_split, 2 * rules.min_samples_leaf)}"
    if rules.criterion == "second_order":
        fair += f" AND bl >= {rules.min_child_weight} AND bt - bl >= {rules.min_child_weight} AND gain > {max(rules.gamma, 1e-6)!r}"
    else:
        fair += " AND at_ > 0 AND bt > 0"
    for k in range(depth):
        ctes += [
            f"c{k} AS (SELECT path, j, bins[j] AS bin, count(*) AS n, sum(a) AS a, sum(b) AS b FROM r{k}, (SELECT unnest(range(1, {len(FEATURES) + 1})) AS j) GROUP BY ALL)",
            f"w{k} AS (SELECT path, j, bin, sum(n) OVER u AS nl, sum(a) OVER u AS al, sum(b) OVER u AS bl, sum(n) OVER p AS nt, sum(a) OVER p AS at_, sum(b) OVER p AS bt FROM c{k} "
            "WINDOW u AS (PARTITION BY path, j ORDER BY bin), p AS (PARTITION BY path, j))",
            f"g{k} AS (SELECT *, {gain} AS gain FROM w{k} WHERE nl < nt)",
            f"s{k} AS (SELECT DISTINCT ON (path) path, j - 1 AS feature, bin, gain FROM g{k} WHERE {fair} ORDER BY path, round(gain / {size}, 10) DESC, j, bin)",
            f"r{k + 1} AS (SELECT r.y, r.a, r.b, r.bins, r.path || CASE WHEN r.bins[s.feature + 1] <= s.bin THEN 'l' ELSE 'r' END AS path FROM r{k} r JOIN s{k} s USING (path))",
        ]
    parts = [f"SELECT t.*, s.feature, s.bin, s.gain FROM (SELECT path, {k} AS depth, count(*) AS n, sum(a) AS a, sum(b) AS b FROM r{k} GROUP BY path) t LEFT JOIN s{k} s USING (path)" for k in range(depth)]
    parts.append(f"SELECT path, {depth}, count(*), sum(a), sum(b), NULL, NULL, NULL FROM r{depth} GROUP BY path")
    ctes.append("nodes AS (" + " UNION ALL ".join(parts) + ")")
    return "WITH " + ",\n".join(ctes)


GINI = trees.Rules(max_depth=4, min_samples_split=60, min_samples_leaf=7)
BOOST = trees.Rules("second_order", 3, reg_lambda=4.0, reg_alpha=1.0, min_child_weight=1.0)
LEAFWISE = trees.Rules("second_order", max_leaves=6, min_samples_leaf=20, min_child_weight=1e-3, reg_lambda=1.0)
CLASSES = ("1e0 - y", "CAST(y AS DOUBLE)")
GRADIENTS = ("0.5e0 - y", "0.25e0")  # of the log loss at margin 0


def nodes_of(model, spark):
    return model.stages[-1].node_table(spark)


@query(
    "fit_tree_grown",
    grown_sql(GINI, 4, *CLASSES)
    + " SELECT path, depth, n, round(a, 6) AS n_bad, round(b, 6) AS n_good, coalesce(feature, -1) AS feature, round(coalesce(gain, 0), 6) AS gain, round(b / (a + b), 8) AS value FROM nodes",
)
def fit_tree_grown(spark, d):
    """All nodes of a tree whose nodes below 60 rows are not split."""
    params = {"max_depth": GINI.max_depth, "min_samples_split": GINI.min_samples_split, "min_samples_leaf": GINI.min_samples_leaf}
    nodes = nodes_of(models.fit_model("DecisionTree", params, tree_rows(spark, d)), spark)
    sums = [F.round("a", 6).alias("n_bad"), F.round("b", 6).alias("n_good")]
    return nodes.select("path", "depth", "n", *sums, "feature", F.round("gain", 6).alias("gain"), F.round("value", 8).alias("value"))


@query(
    "boosted_first_tree",
    grown_sql(BOOST, 3, *GRADIENTS)
    + f""" SELECT path, n, round(a, 6) AS gradient, round(b, 6) AS hessian, coalesce(feature, -1) AS feature, round(coalesce(gain, 0), 6) AS gain,
    round(-sign(a) * greatest(abs(a) - {BOOST.reg_alpha}, 0) / (b + {BOOST.reg_lambda}), 8) AS value FROM nodes""",
)
def boosted_first_tree(spark, d):
    """Gains and leaf values of the first of two second-order trees."""
    params = {"n_estimators": 2, "max_depth": 3, "reg_lambda": BOOST.reg_lambda, "reg_alpha": BOOST.reg_alpha, "learning_rate": 0.1}
    nodes = nodes_of(models.fit_model("XGBoost", params, tree_rows(spark, d)), spark).where("tree = 0")
    sums = [F.round("a", 6).alias("gradient"), F.round("b", 6).alias("hessian")]
    return nodes.select("path", "n", *sums, "feature", F.round("gain", 6).alias("gain"), F.round("value", 8).alias("value"))


def _leafwise_sql() -> str:
    """Five times the node of largest gain among those whose parent has been split."""
    ctes, done = [], []
    for k in range(LEAFWISE.max_leaves - 1):
        taken = " UNION ALL ".join(f"SELECT path FROM p{i}" for i in range(k)) or "SELECT NULL AS path WHERE false"
        ctes.append(
            f"p{k} AS (SELECT {k + 1} AS step, path, n, feature, gain FROM nodes WHERE gain IS NOT NULL AND path NOT IN ({taken}) AND (path = '' OR left(path, length(path) - 1) IN ({taken})) "
            "ORDER BY round(gain, 8) DESC, path LIMIT 1)"
        )
        done.append(f"SELECT step, path, n, feature, round(gain, 6) AS gain FROM p{k}")
    return grown_sql(LEAFWISE, LEAFWISE.max_leaves - 1, *GRADIENTS) + ", " + ", ".join(ctes) + " " + " UNION ALL ".join(done)


@query("leafwise_splits", _leafwise_sql())
def leafwise_splits(spark, d):
    """The splits of a tree of six leaves in the order best-first growth makes them: no later split gains more than one it could have come before."""
    params = {"n_estimators": 1, "num_leaves": LEAFWISE.max_leaves, "reg_lambda": LEAFWISE.reg_lambda, "min_child_samples": LEAFWISE.min_samples_leaf}
    nodes = nodes_of(models.fit_model("LightGBM", params, tree_rows(spark, d)), spark).where("feature >= 0")
    # At most num_leaves rows; the order is replayed from the gains alone.
    left = {r["path"]: r for r in nodes.collect()}
    rows, ready = [], {""}
    while ready & left.keys():
        path = min(ready & left.keys(), key=lambda p: (-round(left[p]["gain"], 8), p))
        r = left.pop(path)
        ready |= {path + "l", path + "r"}
        rows.append((len(rows) + 1, path, r["n"], r["feature"], r["gain"]))
    return spark.createDataFrame(rows, "step int, path string, n long, feature int, gain double").withColumn("gain", F.round("gain", 6))


ALPHAS = (0.0001, 0.0005, 0.002, 0.01, 0.1)
PRUNE = trees.Rules(max_depth=4, min_samples_leaf=5)


def _pruned_sql() -> str:
    """Cheapest pruning from the leaves up: a node stays split only if its parts with their penalties are cheaper."""
    depth = PRUNE.max_depth
    ctes = [f"al AS (SELECT unnest([{', '.join(map(str, ALPHAS))}]) AS alpha)", "tot AS (SELECT n FROM nodes WHERE path = '')"]
    own = "2 * t.a * t.b / (t.a + t.b) / tot.n"
    ctes.append(f"k{depth} AS (SELECT alpha, t.path, {own} + alpha AS cost, {own} AS impurity, 1 AS leaves, least(t.a, t.b) AS errors FROM nodes t, tot, al WHERE t.depth = {depth})")
    for k in reversed(range(depth)):
        kids = f"(SELECT alpha, left(path, {k}) AS path, sum(cost) AS cost, sum(impurity) AS impurity, sum(leaves) AS leaves, sum(errors) AS errors FROM k{k + 1} GROUP BY ALL)"
        pick = f"c.cost IS NULL OR {own} + al.alpha <= c.cost + 1e-12"
        ctes.append(
            f"k{k} AS (SELECT al.alpha, t.path, CASE WHEN {pick} THEN {own} + al.alpha ELSE c.cost END AS cost, CASE WHEN {pick} THEN {own} ELSE c.impurity END AS impurity, "
            f"CASE WHEN {pick} THEN 1 ELSE c.leaves END AS leaves, CASE WHEN {pick} THEN least(t.a, t.b) ELSE c.errors END AS errors "
            f"FROM nodes t CROSS JOIN tot CROSS JOIN al LEFT JOIN {kids} c ON c.path = t.path AND c.alpha = al.alpha WHERE t.depth = {k})"
        )
    return grown_sql(PRUNE, depth, *CLASSES) + ", " + ", ".join(ctes) + " SELECT alpha, leaves::BIGINT AS leaves, errors::BIGINT AS errors, round(impurity, 8) AS impurity FROM k0"


@query("pruned_trees", _pruned_sql())
def pruned_trees(spark, d):
    """Leaves, training errors and impurity of one stored tree pruned at several alphas, the errors counted by scoring the rows."""
    rows = tree_rows(spark, d)
    edges = trees.bin_edges(rows, len(FEATURES), BINS)
    whole = trees.Grower(trees.bin_rows(rows, edges), len(FEATURES), BINS, PRUNE).forest()[0]
    scored, known = None, []
    for alpha in ALPHAS:
        tree = trees.pruned(whole, PRUNE, alpha)
        impurity = sum(trees.loss(tree.a[i], tree.b[i], PRUNE) for i in tree.leaves()) / (whole.a[0] + whole.b[0])
        known.append((alpha, len(tree.leaves()), impurity))
        out = trees.as_stage([tree], edges, PRUNE).transform(rows).select(F.lit(alpha).alias("alpha"), (F.col("prediction") != F.col("label")).alias("wrong"))
        scored = out if scored is None else scored.unionByName(out)
    errors = scored.groupBy("alpha").agg(F.sum(F.when(F.col("wrong"), 1).otherwise(0)).cast("long").alias("errors"))
    told = spark.createDataFrame(known, "alpha double, leaves long, impurity double")
    return told.join(errors, "alpha").select("alpha", "leaves", "errors", F.round("impurity", 8).alias("impurity"))


GROWN_FITS = {
    "fit_forest_grown": ("RandomForest", {"n_estimators": 100, "max_depth": 10, "min_samples_split": 4, "class_weight": "balanced"}),
    "fit_second_order": ("XGBoost", {"n_estimators": 200, "max_depth": 2, "learning_rate": 0.1, "subsample": 0.4, "colsample_bytree": 0.5, "reg_alpha": 1.0, "reg_lambda": 4.0}),
    "fit_leafwise": ("LightGBM", {"n_estimators": 5, "num_leaves": 31}),
}


def _fit(model, params):
    def run(spark, d):
        rows = tree_rows(spark, d)
        fitted = models.fit_model(model, params, rows)
        return classification_metrics(materialize(models.apply_model(fitted, rows, ["key", F.col("label").alias("y_true")]), "scored"))

    return run


for _name, (_model, _params) in GROWN_FITS.items():
    query(_name)(_fit(_model, _params))
