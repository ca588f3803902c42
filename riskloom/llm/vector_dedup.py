"""Embedding near duplicates by NN-descent.

Vectors of a label start with neighbours from random orders (short runs of rows sorted by random sign codes). Then every
vector's neighbours are compared with one another, and better ones replace worse ones, until little changes. A vector whose
list is full of near duplicates is saturated: its list may be too short to hold all links, and refining it is no use. Such lists
are enlarged to the whole group that they hang together with. Members within half the threshold's angle of the group's mean
are linked with one another by the triangle inequality and are only counted; the others are compared with the whole
group, block by block. An audit compares a few vectors with all of
their label, and looks for made-up partners, just above the threshold, that some vectors were given before the search: so
it has links to count however rare the real ones are. As long as links are missing, the search goes on with more orders and
longer lists, and if that does not help, every label is compared block by block. Edges at the threshold, measured in
double precision on the original vectors, are the links.

Copies of a vector are one node with a weight, so they cost nothing in the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.graph import components
from riskloom.llm.shared import Stored, read
from riskloom.llm.vectors import matrix, sound

THRESHOLD = 0.98
#: Neighbours in a list at first; doubled in each further round of the audit.
NEIGHBOURS = 8
#: Random orders that the lists start from and sign bits of a code, both at least (they grow with the largest label), and
#: rows compared in a run of an order.
ORDERS = 5
BITS = 16
RUN = 48
#: The share of pairs at the threshold that may meet in no order, by a rough estimate.
APART = 0.05
#: Rounds of comparing neighbours of neighbours at least, and the share of changed entries below which they end.
ROUNDS = 3
SETTLED = 0.002
#: Vectors audited, vectors given a made-up partner (at most, and at most one in ten), the share of either's links that
#: must be found, and how often the search is widened before every label is compared in full.
AUDIT = 200
PROBES = 500
RECALL = 0.99
WIDENED = 2
#: Rows of a block of a saturated group.
BLOCK = 1_024
#: Single-precision cosines may be off by this much; what is close to the threshold is measured exactly.
SLACK = 1e-4


def _units(column: pa.Array, width: int) -> np.ndarray:
    x = matrix(column, width)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _top(frame: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each u, repeated ones once: u, v, s, whether the entry is new, its place n, and of u the
    length of the list, its worst entry and how many are close.

    ``frame`` has u, v, s, new and close; everything is dealt out by u once.
    """
    once = frame.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"), F.max("close").alias("close"))
    kept = once.withColumn("n", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))).where(F.col("n") <= k)
    whole = Window.partitionBy("u")
    return kept.select("u", "v", "s", "new", "close", "n", F.count(F.lit(1)).over(whole).alias("size"), F.min("s").over(whole).alias("low"), F.sum("close").over(whole).alias("near"))


def _entries(frame: DataFrame, new: int, near: float) -> DataFrame:
    return frame.select("u", "v", "s", F.lit(new).alias("new"), (F.col("s") >= near).cast("int").alias("close"))


def _best(u: np.ndarray, v: np.ndarray, s: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best pairs of each u, repeated ones once."""
    order = np.lexsort((v, -s, u))
    u, v, s = u[order], v[order], s[order]
    once = np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])))[: len(u)]
    u, v, s = u[once], v[once], s[once]
    first = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))[: len(u)])
    place = np.arange(len(u)) - np.repeat(first, np.diff(np.concatenate((first, [len(u)]))))
    return pa.RecordBatch.from_arrays([pa.array(x[place < k]) for x in (u, v, s.astype(np.float32))], names=["u", "v", "s"])


def _runs(width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in a random order: the best neighbours of each row within runs of its label and order."""
        carry = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
            done = table.num_rows - table.num_rows % RUN
            if done:
                yield compare(table.slice(0, done))
            carry = table.slice(done)
        if carry is not None and carry.num_rows > 1:
            yield compare(carry)

    def compare(table: pa.Table) -> pa.RecordBatch:
        node = table.column("node").to_numpy()
        label, turn = table.column("label").to_numpy(), table.column("turn").to_numpy()
        x = _units(table.column("vector").combine_chunks(), width).astype(np.float32)
        us, vs, ss = [], [], []
        for at in range(0, len(node), RUN):
            b = slice(at, at + RUN)
            s = x[b] @ x[b].T
            s[(label[b][:, None] != label[b][None]) | (turn[b][:, None] != turn[b][None])] = -2
            np.fill_diagonal(s, -2)
            m = min(k, len(s) - 1)
            if m < 1:
                continue
            best = np.argpartition(-s, m - 1, axis=1)[:, :m]
            value = np.take_along_axis(s, best, axis=1)
            i, j = np.nonzero(value > -2)
            us.append(node[b][i])
            vs.append(node[b][best[i, j]])
            ss.append(value[i, j])
        u, v, s = (np.concatenate(z) if z else np.zeros(0) for z in (us, vs, ss))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float32())], names=["u", "v", "s"])

    return run


def _orders(rows: int, threshold: float) -> tuple[int, int]:
    """Random orders and sign bits for labels of up to ``rows`` vectors.

    A run holds the rows that share the first bits of a code, one more for each doubling of the label; two vectors at the
    threshold share a bit with a known probability. About half of those that share them all are cut apart by a run's end.
    """
    halvings = float(np.log2(max(1.0, rows / RUN)))
    meet = 0.5 * (1 - np.arccos(min(1.0, threshold)) / np.pi) ** halvings
    return max(ORDERS, int(np.ceil(np.log(APART) / np.log1p(-meet)))), int(np.clip(np.ceil(halvings) + 4, BITS, 31))


def _first_lists(nodes: DataFrame, width: int, k: int, orders: int, bits: int, seed: int) -> DataFrame:
    """Neighbours (u, v, s) from ``orders`` random orders: rows sorted by the signs of random projections, then by one projection."""
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((orders, bits + 1, max(width, 1)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _units(batch.column("vector"), width)
            for t in range(orders):
                p = x @ planes[t].T
                signs = ((p[:, :bits] > 0) << np.arange(bits)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), pa.array(np.full(len(x), t, dtype=np.int32)), pa.array(signs.astype(np.int32)), pa.array(p[:, bits]), batch.column("node"), batch.column("vector")],
                    names=["label", "turn", "code", "place", "node", "vector"],
                )

    rows = nodes.select("label", "node", F.col("vector").cast("array<float>").alias("vector")).mapInArrow(code, "label long, turn int, code int, place double, node long, vector array<float>")
    keys = ["label", "turn", "code", "place", "node"]
    # Range partitions cut through any label or code that many rows share.
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return sorted_rows.mapInArrow(_runs(width, k), "u long, v long, s float")


def _join_lists(width: int, k: int):
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (w, a, bar, vector) sorted by w: pairs of neighbours of one w that would improve a list."""
        carry = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
            w = table.column("w").to_numpy()
            cut = int(np.searchsorted(w, w[-1], "left"))
            if cut:
                yield from pairs(table.slice(0, cut))
            carry = table.slice(cut)
        if carry is not None and carry.num_rows:
            yield from pairs(carry)

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        w = table.column("w").to_numpy()
        a = table.column("a").to_numpy()
        bar = table.column("bar").to_numpy()
        x = _units(table.column("vector").combine_chunks(), width).astype(np.float32)
        start = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        size = np.diff(np.concatenate((start, [len(w)])))
        for n in np.unique(size).tolist():
            groups = start[size == n]
            step = max(1, 2_000_000 // (n * n))
            for at in range(0, len(groups) if n > 1 else 0, step):
                rows = groups[at : at + step][:, None] + np.arange(n)
                s = np.einsum("gid,gjd->gij", x[rows], x[rows])
                g, i, j = np.nonzero((s > bar[rows][:, :, None]) & (a[rows][:, :, None] != a[rows][:, None, :]))
                yield _best(a[rows[g, i]], a[rows[g, j]], s[g, i, j], k)

    return local


def _refined(lists: DataFrame, nodes: DataFrame, width: int, k: int, near: float, stored: Stored) -> tuple[DataFrame, int, bool]:
    """One round: compare the neighbours of every node with one another.

    Returns the new lists, the entries that changed, and whether those of at least ``near`` have settled. Lists full of
    these take no new entries and do not count, as their groups are looked at as a whole.
    """
    ahead = lists.select(F.col("u").alias("w"), F.col("v").alias("a"), "s", F.lit(False).alias("back"))
    back = lists.select(F.col("v").alias("w"), F.col("u").alias("a"), "s", F.lit(True).alias("back"))
    # Nodes that many lists name hand on their k nearest admirers; the audit tells whether that loses links.
    place = F.row_number().over(Window.partitionBy("w", "back").orderBy(F.desc("s"), "a"))
    around = ahead.union(back).repartition("w").withColumn("n", place).where(~F.col("back") | (F.col("n") <= k)).select("w", "a").distinct()
    bar = F.when(F.col("near") >= k, F.lit(2.0)).when(F.col("size") >= k, F.col("low")).otherwise(F.lit(-2.0)).cast("float")
    bars = lists.where(F.col("n") == 1).select(F.col("u").alias("node"), bar.alias("bar"))
    known = nodes.select("node", "vector").join(bars, "node", "left").select(F.col("node").alias("a"), F.coalesce("bar", F.lit(-2.0).cast("float")).alias("bar"), "vector")
    rows = around.join(known, "a").select("w", "a", "bar", "vector")
    found = rows.repartition("w").sortWithinPartitions("w").mapInArrow(_join_lists(width, k), "u long, v long, s float")
    open_list = F.col("near") < k
    better, _ = stored.put(_top(_entries(lists, 0, near).union(_entries(found, 1, near)), k))
    # Three narrow columns of the stored lists; ``DataFrame.observe`` would leave the session unserialisable for later jobs.
    count = better.agg(
        F.sum("new").alias("new"), F.sum(F.when(open_list, F.col("new") * F.col("close"))).alias("new_close"), F.sum(F.when(open_list, F.col("close"))).alias("close")
    ).first()
    return better, count["new"] or 0, (count["new_close"] or 0) <= SETTLED * (count["close"] or 0)


def _exact(width: int):
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = matrix(batch.column("x"), width), matrix(batch.column("y"), width)
            cosine = (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("u", "v", "cu", "cv")), pa.array(cosine)], names=["u", "v", "cu", "cv", "cosine"])

    return exact


def _links(lists: DataFrame, nodes: DataFrame, width: int, threshold: float) -> DataFrame:
    """(u, v, cu, cv), u < v: pairs of the lists at the threshold, measured in double precision, and the copies of both."""
    near = lists.where(F.col("s") >= threshold - SLACK).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    x = nodes.select(F.col("node").alias("u"), F.col("vector").alias("x"), F.col("copies").alias("cu"))
    y = nodes.select(F.col("node").alias("v"), F.col("vector").alias("y"), F.col("copies").alias("cv"))
    both = near.join(x, "u").join(y, "v").select("u", "v", "x", "y", "cu", "cv")
    return both.mapInArrow(_exact(width), "u long, v long, cu long, cv long, cosine double").where(F.col("cosine") >= threshold).select("u", "v", "cu", "cv")


def _joined(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row and column of a table of links, the first row that it hangs together with; the number of rows if none."""
    row = np.arange(len(on))
    while True:
        column = np.where(on, row[:, None], len(on)).min(axis=0, initial=len(on))
        following = np.minimum(row, np.where(on, column[None], len(on)).min(axis=1, initial=len(on)))
        if (following == row).all():
            return row, column
        row = following


def _within(width: int, threshold: float):
    def block_pair(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Links between the rows of two blocks of a group (or within one): per row, the weight it is linked with and a row it hangs together with."""
        _, i, j = key
        left, right = frame[frame["block"] == i], frame[frame["block"] == j]

        def parts(rows: pd.DataFrame):
            x = np.array(rows["vector"].tolist(), dtype=np.float64).reshape(len(rows), width)
            return x / np.linalg.norm(x, axis=1, keepdims=True), rows["node"].to_numpy(), rows["copies"].to_numpy()

        (x, a, ca), (y, b, cb) = parts(left), parts(right)
        s = x @ y.T
        if i == j:
            np.fill_diagonal(s, -2)
        on = s >= threshold
        for r, c in zip(*np.nonzero(np.abs(s - threshold) < 1e-9), strict=True):  # as near as rounding: by the plain formula
            u, v = np.array(left["vector"].iloc[r], dtype=np.float64), np.array(right["vector"].iloc[c], dtype=np.float64)
            on[r, c] = (u * v).sum() / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold
        row, column = _joined(on | np.eye(len(a), dtype=bool) if i == j else on)
        out = [pd.DataFrame({"node": a, "links": on @ cb, "other": a[row]})]
        if i != j:
            out.append(pd.DataFrame({"node": b, "links": on.T @ ca, "other": np.where(column < len(a), a[np.minimum(column, len(a) - 1)] if len(a) else b, b)}))
        return pd.concat(out)

    return block_pair


def _audit(shared, width: int, threshold: float):
    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, x = shared.value
        for batch in batches:
            y = _units(batch.column("vector"), width)
            node, label = batch.column("node").to_numpy(), batch.column("label").to_numpy()
            on = (x @ y.T >= threshold) & (labels[:, None] == label[None]) & (ids[:, None] != node[None])
            i, j = np.nonzero(on)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(node[j])], names=["u", "v"])

    return audit


def _partners(chosen: pa.Table, width: int, threshold: float) -> tuple[pa.Table, pa.Table]:
    """Made-up partners of nodes, just above the threshold in a random direction: (nodes of no copies, pairs u and v)."""
    rng = np.random.default_rng(13)
    x = matrix(chosen.column("vector").combine_chunks(), width)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) / norm**2 * x
    away /= np.linalg.norm(away, axis=1, keepdims=True) + 1e-30
    cosine = min(1.0, threshold + 0.01 * (1 - threshold) + 1e-6)
    y = (cosine * x + np.sqrt(1 - cosine**2) * norm * away).astype(np.float32)
    node = pa.array(rng.integers(-(2**63), 2**63 - 1, len(x)), pa.int64())
    zero = pa.array(np.zeros(len(x), dtype=np.int64))
    made = pa.table({"node": node, "low": zero, "copies": zero, "label": chosen.column("label"), "vector": pa.array(list(y), chosen.column("vector").type)})
    return made, pa.table({"u": chosen.column("node"), "v": node})


def _label_key(vectors: DataFrame, label: str) -> Column:
    """Labels as 64-bit keys: whole numbers as they are, other labels by a digest that no two of them share."""
    if vectors.schema[label].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.col(label).cast("long")
    text = F.col(label).cast("string")
    for salt in range(8):
        key = F.when(F.col(label).isNotNull(), F.xxhash64(text, F.lit(salt)))
        if vectors.select(key.alias("key"), text.alias("text")).groupBy("key").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a != b").isEmpty():
            return key
    raise RuntimeError("labels could not be told apart by 64-bit digests")


def _nodes(stored: Stored, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, node) of the rows (id, label, vector), and the nodes: rows of equal label and vector share one.

    A node's name is a digest; a second digest tells whether two vectors share a name, and then all names are drawn anew.
    """
    for salt in range(8):
        named, _ = stored.put(rows.select("id", F.xxhash64("label", "vector", F.lit(salt)).alias("node"), F.xxhash64(F.lit(salt + 101), "vector", "label").alias("other"), "label", "vector"))
        nodes, path = stored.put(
            named.groupBy("node").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"), (F.min("other") != F.max("other")).alias("clash"))
        )
        if nodes.where("clash").isEmpty():
            return named.select("id", "node"), nodes.drop("clash")
        stored.drop(path)
    raise RuntimeError("vectors could not be told apart by 64-bit digests")


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: vectors of an equal label are linked at ``threshold`` cosine.

    Null labels, null ids, and null, zero or non-finite vectors link with nothing and are kept (component: their own id; a null
    id is not kept). Labels may be of any type that can be cast to a string. Vectors are compared with those of their own length, each
    length in a search of its own; components of any numeric type are measured in double precision. Repeated rows are
    copies of a vector, linked with one another. An empty table gives an empty table. Only the three columns named are read.
    """
    spark = vectors.sparkSession
    stored = Stored(spark, "vector-dedup")
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    base = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast(kind).alias("vector"), _label_key(vectors, label).alias("label"))
    fit = F.coalesce(sound(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False))
    base, _ = stored.put(base.select("id", "label", "vector", fit.alias("fit")))
    usable = base.where("fit").select("id", "label", "vector", F.size("vector").alias("width"))
    # Lengths of which some label has two vectors; there are as many searches as lengths.
    widths = [r[0] for r in usable.groupBy("width", "label").count().where("count > 1").select("width").distinct().orderBy("width").collect()]
    found = [_linked(stored, usable.where(F.col("width") == w).drop("width"), w, threshold) for w in widths]
    alone = base.where(~F.col("fit") | ~F.size("vector").isin(widths)) if widths else base
    out = alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    for rows in found:
        out = out.union(rows)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("id").alias(id_column), "n_links", "component_id", kept.alias("kept"))


def _linked(stored: Stored, rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """(id, n_links, component_id) of rows (id, label, vector) whose vectors are sound and of length ``width``."""
    spark = rows.sparkSession
    named, real = _nodes(stored, rows)
    total, largest = real.groupBy("label").count().agg(F.sum("count"), F.max("count")).first()
    drawn = real.orderBy(F.xxhash64("node", F.lit("audit"))).limit(max(AUDIT, PROBES)).select("node", "label", "vector").toArrow()
    made, pairs = _partners(drawn.slice(0, min(PROBES, -(-total // 10))), width, threshold)
    made, _ = stored.put(spark.createDataFrame(made, real.schema))
    true, _ = stored.put(_true_links(spark, real, drawn.slice(0, AUDIT), width, threshold))
    asked = spark.createDataFrame(pairs, "u long, v long").withColumn("made", F.lit(True)).union(true.withColumn("made", F.lit(False)))
    nodes = real.union(made)
    orders, bits = _orders(largest, threshold)
    k, near = NEIGHBOURS, threshold - SLACK
    lists = None
    for widened in range(WIDENED + 1):
        start = _entries(_first_lists(nodes, width, k, orders, bits, seed=widened), 1, near)
        lists, _ = stored.put(_top(start if lists is None else _entries(lists, 0, near).union(start), k))
        rounds, changed, settled = 0, total * k, False
        while changed > SETTLED * total * k and not (settled and rounds >= ROUNDS):
            lists, changed, settled = _refined(lists, nodes, width, k, near, stored)
            rounds += 1
        every, _ = stored.put(_links(lists, nodes, width, threshold))
        # The made-up partners, which have no copies, are asked about but connect nothing.
        links = every.where("cu > 0 and cv > 0")
        groups, _ = stored.put(components(links.select(F.col("u").alias("a"), F.col("v").alias("b"))))
        full = lists.where((F.col("n") == 1) & (F.col("near") >= k)).select(F.col("u").alias("node"))
        # The groups of saturated nodes, whole.
        wide, _ = stored.put(groups.join(groups.join(full, "node").select("component").distinct(), "component").select("node", "component"))
        recall = _recall(stored, asked, every, wide)
        if recall >= RECALL:
            break
        k *= 2
        orders *= 2
    if recall < RECALL:
        # Links are still missing: every label is a group to be compared in full.
        wide = real.select("node", F.col("label").alias("component"))
    counts, inside = _whole_groups(stored, wide, real, width, threshold)
    outer = links.join(wide.select(F.col("node").alias("u")), "u", "left_anti")
    counts = counts.union(outer.select("u", "cv")).union(outer.select("v", "cu")).groupBy("node").agg(F.sum("links").alias("links"))
    if recall < RECALL:
        groups = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")).union(inside))
    described = real.select("node", "low", "copies").join(counts, "node", "left").join(groups, "node", "left")
    described = described.select("node", "low", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("group"))
    lowest = described.groupBy("group").agg(F.min("low").alias("component_id"))
    described, _ = stored.put(described.join(lowest, "group").select("node", "n_links", "component_id"))
    return named.join(described, "node").select("id", "n_links", "component_id")


def _whole_groups(stored: Stored, wide: DataFrame, nodes: DataFrame, width: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Of groups (node, component): the copies that each node is linked with (node, links; to be summed), and pairs of nodes
    that hang together (a, b), which join whatever hangs together in a group.

    The core, within half the threshold's angle of the group's mean, needs no comparison among itself.
    """
    unit = array_to_vector(F.transform("vector", lambda x: x.cast("double")))
    member = wide.join(nodes.select("node", "copies", "vector"), "node").withColumn("unit", unit)
    mean = member.groupBy("component").agg(Summarizer.mean(F.col("unit")).alias("mean"))
    # A mean of vectors of unlike lengths is as good a point as any: the triangle inequality holds for all.
    mean = mean.select("component", vector_to_array("mean").alias("mean"))
    limit = float(np.cos(np.arccos(threshold) / 2 - 1e-6))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, b: a + b)
    cosine = dot(F.col("vector"), F.col("mean")) / F.sqrt(dot(F.col("vector"), F.col("vector")) * dot(F.col("mean"), F.col("mean")))
    core = F.coalesce((cosine >= limit) & (F.lit(threshold) > 0), F.lit(False))
    member, _ = stored.put(member.drop("unit").join(mean, "component").select("component", "node", "copies", "vector", core.alias("core")))
    size = member.groupBy("component").agg(
        F.ceil(F.count_if(~F.col("core")) / BLOCK).cast("int").alias("rest"),
        F.ceil(F.count_if("core") / BLOCK).cast("int").alias("cores"),
        F.sum(F.when(F.col("core"), F.col("copies"))).alias("weight"),
        F.min(F.when(F.col("core"), F.col("node"))).alias("first"),
    )
    cut = member.join(size, "component")
    sure = cut.where("core")
    spread = F.xxhash64("node", F.lit("block"))
    block = F.when(F.col("core"), F.col("rest") + F.pmod(spread, F.col("cores"))).otherwise(F.pmod(spread, F.col("rest"))).cast("int")
    # A block meets every block of its group once, as the first or as the second of the pair, but core blocks only the others.
    last = F.when(F.col("core"), F.col("rest")).otherwise(F.col("rest") + F.col("cores")) - 1
    dealt = cut.where("rest > 0").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", F.col("vector").cast("array<double>").alias("vector"))
    met, _ = stored.put(dealt.groupBy("component", "i", "j").applyInPandas(_within(width, threshold), "node long, links long, other long"))
    counts = met.select("node", "links").union(sure.select("node", F.col("weight") - F.col("copies")))
    return counts, met.select(F.col("node").alias("a"), F.col("other").alias("b")).union(sure.select("node", "first"))


def _true_links(spark: SparkSession, nodes: DataFrame, audited: pa.Table, width: int, threshold: float) -> DataFrame:
    """(u, v): the audited nodes' links with all nodes of their label."""
    x = _units(audited.column("vector").combine_chunks(), width)
    shared = spark.sparkContext.broadcast((audited.column("node").to_numpy(), audited.column("label").to_numpy(), x))  # AUDIT vectors
    return nodes.mapInArrow(_audit(shared, width, threshold + 1e-9), "u long, v long")


def _recall(stored: Stored, asked: DataFrame, links: DataFrame, wide: DataFrame) -> float:
    """The share found of the pairs asked for (u, v, made), real and made-up ones apart, the smaller of the two; 1 if there are none.

    Found are links and members of one saturated group; a made-up partner belongs to the groups of what it is linked with.
    """
    both = links.select("u", "v", "cu").union(links.select("v", "u", "cv"))
    number = dict(asked.groupBy("made").count().collect())
    missed, _ = stored.put(asked.join(both, ["u", "v"], "left_anti"))
    lost = dict(missed.groupBy("made").count().collect())
    if lost:
        place = wide.union(both.where("cu = 0").select(F.col("u"), F.col("v").alias("node")).join(wide, "node").select("u", "component"))
        a, b = place.select(F.col("node").alias("u"), F.col("component").alias("c")), place.select(F.col("node").alias("v"), F.col("component").alias("c"))
        for made, n in missed.join(a, "u").join(b, ["v", "c"]).select("u", "v", "made").distinct().groupBy("made").count().collect():
            lost[made] -= n
    return min([1 - lost.get(made, 0) / n for made, n in number.items()], default=1.0)


def op9_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: vec_id, n_links, component_id, kept for every vector."""
    return near_duplicates(read(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
