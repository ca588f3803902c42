"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens goes down a tree (domain, language, source): every node shares its budget among its children by
their weights. A child that cannot use its share (its subtree holds too few tokens, even with all allowed epochs)
leaves the rest to its siblings; only what a whole family cannot use goes to the parent's siblings. A leaf then
takes its documents in a seeded order, epoch after epoch, as the longest prefix that stays within its budget.

The order is a digest of seed, epoch and id, so no sort of all rows is needed: tokens are summed by the digest's leading
bits, and only the range in which a leaf's budget ends is looked at more closely, twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.shared import Stored, fresh, read

SEED = "mix-1"
#: How often one document may be used.
EPOCHS = 2
#: The budget as a share of all tokens there are.
SHARE = 0.5
NONE = "(none)"
LEVELS = ("domain", "lang", "source")
#: Whole-number weights by level; "*" is for values not named.
WEIGHTS = {
    "domain": {"crawl": 50, "books": 20, "forum": 10, "reference": 20, "*": 5},
    "lang": {"en": 60, "de": 15, "fr": 15, "es": 10, "*": 5},
    "source": {"*": 1},
}
#: Leading digest bits that a look at a leaf's order resolves at a time, of 60.
STEP = 12
#: Leaves joined by broadcast up to this number; more are joined by shuffle.
SMALL_LEAVES = 20_000


def domain_of(source: Column) -> Column:
    """The domain of a source name: what the number in it says; sources without one are ``(none)``."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    n = F.when(number != "", number).cast("int")
    return F.when(n.isNull(), NONE).when(n == 0, "crawl").when(n <= 6, "books").when(n <= 12, "forum").otherwise("reference")


def token_estimate(text: Column) -> Column:
    """About four characters a token; none for a null text."""
    return F.coalesce(F.floor((F.length(text) + 3) / 4), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    table = weights[level]
    out = F.lit(int(table.get("*", 0)))
    for value, w in table.items():
        if value != "*":
            out = F.when(F.col(level) == value, int(w)).otherwise(out)
    return out.cast("long")


def _shared_out(children: DataFrame, parents: list[str], level: str, weights: dict[str, dict[str, int]]) -> DataFrame:
    """``children`` (cap, budget of the parent) with their own budget: the parent's shared by weight, up to each cap."""
    rated = children.withColumn("w", _weight(level, weights)).withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")))
    family = Window.partitionBy(*parents, F.col("ratio").isNull()) if parents else Window.partitionBy(F.col("ratio").isNull())
    order = family.orderBy("ratio", level)
    used = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = rated.withColumn("rate", F.when(F.col("w") > 0, (F.col("parent") - used) / rest))
    # Children are full up to the first whose share is below its cap; that one's rate holds for all behind it.
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    line = F.first(F.when(F.col("ratio") > F.col("rate"), F.col("rate")), ignorenulls=True).over(whole)
    own = F.when(F.col("w") <= 0, 0).when(F.col("line").isNull() | (F.col("ratio") <= F.col("line")), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.floor(F.col("line") * F.col("w")))
    )
    return leveled.withColumn("line", line).withColumn("budget", own.cast("long")).select(*parents, level, "cap", "budget")


def budgets(leaves: DataFrame, levels: tuple[str, ...], total: int, weights: dict[str, dict[str, int]], epochs: int) -> DataFrame:
    """(levels, tokens, budget) per leaf from (levels, tokens): the total shared out from the root down.

    What a node can use is what its leaves of positive weight hold, so nothing is kept back for values of weight 0.
    """
    names = list(levels)
    at = None
    wanted = F.lit(True)
    for level in names:
        wanted = wanted & (_weight(level, weights) > 0)
    rated = leaves.withColumn("usable", F.when(wanted, F.col("tokens")).otherwise(0))
    for k, level in enumerate(names):
        table = rated.groupBy(*names[: k + 1]).agg((F.sum("usable") * epochs).cast("long").alias("cap"))
        if at is None:
            children = table.withColumn("parent", F.lit(int(total)).cast("long"))
        else:
            children = table.join(at.select(*names[:k], F.col("budget").alias("parent")), names[:k])
        at = _shared_out(children, names[:k], level, weights)
    return leaves.join(at.select(*names, "budget"), names)


def order_of(seed: str, epoch: Column, ident: Column) -> Column:
    """A number below 2**60 that places a document in the order of an epoch."""
    text = F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(ident.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _crossing(sums: DataFrame, leaf: str, bucket: str) -> DataFrame:
    """Per leaf the first bucket in which the running sum of tokens passes ``room``, and the room left before it."""
    run = Window.partitionBy(leaf).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = sums.withColumn("upto", F.sum("tokens").over(run))
    past = upto.where(F.col("upto") > F.col("room"))
    return past.groupBy(leaf).agg(F.min(F.struct(F.col(bucket), (F.col("room") - F.col("upto") + F.col("tokens")).alias("left"))).alias("x")).select(
        leaf, F.col(f"x.{bucket}").alias(f"{bucket}_cut"), F.col("x.left").alias("room_left")
    )


def plan(
    docs: DataFrame, levels: tuple[str, ...], ident: Column, tokens: Column, share: float, weights: dict[str, dict[str, int]], epochs: int, seed: str
) -> DataFrame:
    """One row per leaf: levels, tokens, budget, full (whole epochs), last_order and last_id (where the prefix ends)."""
    stored = Stored(docs.sparkSession, "mixing")
    names = list(levels)
    narrow = docs.select(*names, ident.cast("long").alias("ident"), tokens.alias("tokens"))
    narrow, _ = stored.put(narrow)
    leaves = narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    shared = budgets(leaves, levels, int(total * share), weights, epochs)
    shared = shared.withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int"))
    shared = shared.withColumn("room", F.col("budget") - F.col("full") * F.col("tokens")).withColumn("leaf", F.xxhash64(*names))
    shared, _ = stored.put(shared)
    # Rows of leaves whose last epoch is a part, with their place in that epoch's order.
    part = shared.where("room > 0 and tokens > 0").select(*names, "leaf", "full", "room")
    rows = _join_leaves(narrow, part, names).withColumn("h", order_of(seed, F.col("full"), F.col("ident"))).select("leaf", "room", "h", "ident", "tokens")
    first = rows.groupBy("leaf", "room", F.shiftright("h", 60 - STEP).alias("b1")).agg(F.sum("tokens").alias("tokens"))
    cut1, _ = stored.put(_crossing(first, "leaf", "b1"))
    near = _join_leaves(rows, cut1, ["leaf"]).where(F.shiftright("h", 60 - STEP) == F.col("b1_cut")).select("leaf", F.col("room_left").alias("room"), "h", "ident", "tokens")
    near, _ = stored.put(near)
    second = near.groupBy("leaf", "room", F.shiftright("h", 60 - 2 * STEP).alias("b2")).agg(F.sum("tokens").alias("tokens"))
    cut2 = _crossing(second, "leaf", "b2")
    last = near.drop("room").join(cut2, "leaf").where(F.shiftright("h", 60 - 2 * STEP) == F.col("b2_cut"))
    # A leaf's 2**-24 part of its rows: equal places (repeated rows) stay together.
    run = Window.partitionBy("leaf").orderBy("h", "ident")
    placed = last.withColumn("upto", F.sum("tokens").over(run))
    ends = placed.groupBy("leaf", "b2_cut").agg(F.max(F.when(F.col("upto") <= F.col("room_left"), F.struct("h", "ident"))).alias("x"))
    before = F.shiftleft(F.col("b2_cut"), 60 - 2 * STEP) - 1
    ends = ends.select("leaf", F.coalesce(F.col("x.h"), before).alias("last_order"), F.when(F.col("x").isNotNull(), F.col("x.ident")).otherwise(F.lit(2**63 - 1)).alias("last_id"))
    done, _ = stored.put(shared.join(ends, "leaf", "left").select(*names, "tokens", "budget", "full", "room", "last_order", "last_id"))
    return done


def _join_leaves(rows: DataFrame, leaves: DataFrame, on: list[str]) -> DataFrame:
    """Rows with their leaf; leaves are one row per source, broadcast when few were counted."""
    few = leaves.limit(SMALL_LEAVES + 1).count() <= SMALL_LEAVES
    return rows.join(F.broadcast(leaves) if few else leaves, on)


def mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    share: float = SHARE, weights: dict[str, dict[str, int]] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED,
    epoch: str | None = "epoch", domain: str | None = "domain", tokens: str | None = "n_tokens",
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once for each epoch that takes them.

    ``epoch``, ``domain`` and ``tokens`` name further columns (None: left out). Null languages and sources are values of
    their own; null and empty texts have no tokens and go with the prefix. Repeated rows and equal ids have one place in the
    order and are taken together. A value of weight 0 is never taken. An empty table gives an empty table. All columns
    pass unchanged; an output column that exists already is an error. Texts are not shuffled.
    """
    for name in (epoch, domain, tokens):
        if name and fresh(docs, name) != name:
            raise ValueError(f"the table already has a column {name}")
    own = docs.columns
    keys = [fresh(docs, f"mix_{x}") for x in LEVELS]
    size = fresh(docs, "mix_size")
    keyed = docs.withColumns(
        {keys[0]: domain_of(F.col(source)), keys[1]: F.coalesce(F.col(lang), F.lit(NONE)), keys[2]: F.coalesce(F.col(source), F.lit(NONE)), size: token_estimate(F.col(text))}
    )
    tree = keyed.select(F.col(id_column).alias("ident"), F.col(size).alias("size"), *[F.col(k).alias(n) for k, n in zip(keys, LEVELS, strict=True)])
    leaves = plan(tree, LEVELS, F.col("ident"), F.col("size"), share, weights, epochs, seed)
    prefix = "mix_leaf_"
    named = leaves.select(*[F.col(n).alias(k) for k, n in zip(keys, LEVELS, strict=True)], *[F.col(c).alias(fresh(docs, prefix + c)) for c in ("full", "room", "last_order", "last_id")])
    full, room, last_order, last_id = (F.col(fresh(docs, prefix + c)) for c in ("full", "room", "last_order", "last_id"))
    joined = _join_leaves(keyed, named, keys)
    place = order_of(seed, full, F.col(id_column))
    # Without an end the whole last epoch fits (its tokens are the room left), or there is none.
    in_last = (room > 0) & (last_order.isNull() | (place < last_order) | ((place == last_order) & (F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))) <= F.coalesce(last_id, F.lit(-(2**63))))))
    taken = full + F.when(in_last, 1).otherwise(0)
    at = fresh(docs, "mix_epoch")
    out = joined.where(taken > 0).withColumn(at, F.explode(F.sequence(F.lit(0), (taken - 1).cast("int"))))
    extra = [F.col(x).alias(name) for x, name in ((at, epoch), (keys[0], domain), (size, tokens)) if name]
    return out.select(*[F.col(f"`{c}`") for c in own], *extra)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, domain, lang, source, epoch and n_tokens of every document that the mix takes, once per epoch."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")


def _sql_weight(level: str) -> str:
    named = " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in WEIGHTS[level].items() if v != "*")
    rest = WEIGHTS[level].get("*", 0)
    return f"CASE {named} ELSE {rest} END" if named else str(rest)


def _sql_level(k: int) -> str:
    names, parents, level = ", ".join(LEVELS[: k + 1]), ", ".join(LEVELS[:k]), LEVELS[k]
    family = f"PARTITION BY {parents} " if parents else ""
    parent = f"JOIN share{k - 1} p USING ({parents})" if k else "CROSS JOIN (SELECT CAST(floor(coalesce(sum(tokens), 0) * {share}) AS BIGINT) AS budget FROM leaves) p".replace("{share}", str(SHARE))
    return f"""
caps{k} AS (SELECT {names}, CAST(sum(CASE WHEN {" AND ".join(f"{_sql_weight(n)} > 0" for n in LEVELS)} THEN tokens ELSE 0 END) * {EPOCHS} AS BIGINT) AS cap FROM leaves GROUP BY {names}),
rated{k} AS (
  SELECT {", ".join("c." + n for n in LEVELS[: k + 1]) if not k else names}, c.cap, p.budget AS parent, {_sql_weight(level)} AS w, c.cap / CAST({_sql_weight(level)} AS DOUBLE) AS ratio
  FROM caps{k} c {parent}),
rates{k} AS (
  SELECT *, (parent - coalesce(sum(cap) OVER ({family}ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / CAST(sum(w) OVER ({family}ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate
  FROM rated{k}),
lines{k} AS (
  SELECT *, first_value(CASE WHEN ratio > rate THEN rate END IGNORE NULLS) OVER ({family}ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS line
  FROM rates{k}),
share{k} AS (
  SELECT {names}, CAST(CASE WHEN line IS NULL OR ratio <= line THEN cap ELSE least(cap, floor(line * w)) END AS BIGINT) AS budget FROM lines{k}),"""


#: The same mix with plain running sums over each leaf.
OP8_SQL = f"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source, lang AS own_lang, source AS own_source,
    coalesce(CAST(floor((length(text) + 3) / 4) AS BIGINT), 0) AS tokens,
    CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS INT) AS n
  FROM documents),
docs AS (
  SELECT *, CASE WHEN n IS NULL THEN '{NONE}' WHEN n = 0 THEN 'crawl' WHEN n <= 6 THEN 'books' WHEN n <= 12 THEN 'forum' ELSE 'reference' END AS domain
  FROM base),
leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM docs GROUP BY domain, lang, source),
{"".join(_sql_level(k) for k in range(len(LEVELS)))}
planned AS (
  SELECT l.domain, l.lang, l.source, CASE WHEN l.tokens > 0 THEN s.budget // l.tokens ELSE 0 END AS whole, s.budget, l.tokens AS all_tokens
  FROM leaves l JOIN share2 s USING (domain, lang, source)),
placed AS (
  SELECT d.*, p.whole, p.budget - p.whole * p.all_tokens AS room,
    CAST('0x' || substr(md5('{SEED}:' || CAST(p.whole AS INT) || ':' || d.doc_id), 1, 15) AS BIGINT) AS h
  FROM docs d JOIN planned p USING (domain, lang, source)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id) AS upto FROM placed),
taken AS (SELECT *, CAST(whole + CASE WHEN room > 0 AND upto <= room THEN 1 ELSE 0 END AS INT) AS times FROM summed)
SELECT doc_id, domain, own_lang AS lang, own_source AS source, CAST(e.epoch AS INT) AS epoch, tokens AS n_tokens
FROM taken, LATERAL (SELECT unnest(range(times)) AS epoch) e
"""
