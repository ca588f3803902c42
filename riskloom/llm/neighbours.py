"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts so that few edges cross; a small network learns which
part a vector belongs to. Every row is filed under its most probable part. A query is routed to its several most
probable parts, whose rows are ranked by their exact distance. How many parts a query visits is set by an audit: for a
few vectors the true neighbours are found by comparing with everything, and visits grow until they meet the wanted recall.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.shared import Stored, read
from riskloom.llm.vectors import matrix, sound, usual_length

#: Vectors that the parts are learned from (those with the smallest digests of their ids).
SAMPLE = 6_000
PARTS = 16
GRAPH_NEIGHBOURS = 10
HIDDEN = 96
EPOCHS = 25
#: Vectors whose true neighbours set the number of visits, and the recall they must reach on average.
AUDIT = 300
RECALL = 0.95
#: Queries sent to all executors at a time; with the vector length this bounds the broadcast.
QUERY_BLOCK = 4_096
#: Distances worked out at a time in a task.
CELLS = 4_000_000


@dataclass
class Router:
    """Layers of the network; parts by falling probability for any vectors."""

    layers: list[tuple[np.ndarray, np.ndarray]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        (w1, b1), (w2, b2) = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row, in blocks."""
    square = (x**2).sum(axis=1)
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1_024):
        d = square[at : at + 1_024, None] + square[None] - 2 * x[at : at + 1_024] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out[at : at + 1_024] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(near: np.ndarray, parts: int, rounds: int = 60, seed: int = 7) -> np.ndarray:
    """Parts of equal size of a neighbour graph, by halving again and again.

    Each half keeps neighbours together: values are averaged along the edges until they vary slowly over the graph, and
    the median cuts the nodes in two; then pairs of nodes that would both rather be on the other side change places.
    """
    n, k = near.shape
    part = np.zeros(n, dtype=np.int64)
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), k), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    for _ in range(int(np.log2(parts))):
        inside = part[a] == part[b]
        u, v = a[inside], b[inside]
        degree = np.bincount(u, minlength=n) + 1
        size = np.bincount(part)
        value = rng.standard_normal(n)
        for _ in range(rounds):
            value = (np.bincount(u, weights=value[v], minlength=n) + value) / degree
            value -= (np.bincount(part, weights=value) / size)[part]
            value /= np.sqrt(np.bincount(part, weights=value**2) / size)[part] + 1e-30
        order = np.lexsort((np.arange(n), value, part))
        start = np.cumsum(size) - size
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        side = (rank - start[part] >= size[part] // 2).astype(np.int64)
        for _ in range(4):
            across = np.bincount(u, weights=(side[u] != side[v]) * 1.0, minlength=n) * 2 - np.bincount(u, minlength=n)
            for p in np.unique(part):
                movers = [np.flatnonzero((part == p) & (side == s) & (across > 0)) for s in (0, 1)]
                m = min(len(movers[0]), len(movers[1])) // 2
                for s in (0, 1):
                    side[movers[s][np.argsort(-across[movers[s]], kind="stable")[:m]]] = 1 - s
        part = part * 2 + side
    return part


def train_router(x: np.ndarray, part: np.ndarray, parts: int, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 11) -> Router:
    """A network with one hidden layer that predicts the part of a vector (Adam, soft cross entropy)."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    scale = 1.0 / max(1e-30, x.std() * np.sqrt(d))
    weights = [rng.standard_normal((d, hidden)) * scale, np.zeros(hidden), rng.standard_normal((hidden, parts)) / np.sqrt(hidden), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    unit = [scale, 1.0, 1.0, 1.0]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), part[rows]] -= 1
            p /= len(rows)
            back = (p @ weights[2].T) * (h > 0)
            gradients = [x[rows].T @ back, back.sum(axis=0), h.T @ p, p.sum(axis=0)]
            step += 1
            for i, g in enumerate(gradients):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] -= 0.003 * unit[i] * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-12)
    return Router([(weights[0], weights[1]), (weights[2], weights[3])])


@dataclass
class Index:
    """All rows by part, as a stored table (part, id, vector), with the router and the number of visits."""

    table: DataFrame
    router: Router
    width: int
    parts: int
    visits: int
    recall: float


def _filing(shared, width: int):
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            part = shared.value.scores(x).argmax(axis=1) if len(x) else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), batch.column("id"), batch.column("vector")], names=["part", "id", "vector"])

    return file


def build_index(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", parts: int = PARTS, recall: float = RECALL, neighbours: int = 10) -> Index:
    """File every sound vector under its most probable part and set the visits by an audit.

    Null, zero and non-finite vectors, vectors without an id, and vectors of another than the commonest length are left
    out. Few rows, or none, make one part. Repeated (id, vector) rows are filed once.
    """
    spark = vectors.sparkSession
    stored = Stored(spark, "neighbours")
    rows = vectors.where(sound(F.col(vector)) & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    width = usual_length(rows, "vector")
    rows = rows.where(F.size("vector") == width)
    order = [F.xxhash64("id", F.lit("parts")), F.col("id")]
    # Ids are drawn, not rows, so that a row that stands many times is one of the sample.
    drawn = rows.select("id").distinct().orderBy(*order).limit(SAMPLE)
    sample = rows.join(F.broadcast(drawn), "id").distinct().orderBy(*order, "vector").limit(SAMPLE).select("vector").toArrow()
    x = matrix(sample.column("vector").combine_chunks(), width) if sample.num_rows else np.zeros((0, max(width, 1)))
    if len(x) < 20 * parts:
        parts = 1
    if parts == 1:
        router = Router([(np.zeros((max(width, 1), 1)), np.zeros(1)), (np.zeros((1, 1)), np.zeros(1))])
    else:
        router = train_router(x, balanced_parts(_graph(x, GRAPH_NEIGHBOURS), parts), parts)
    shared = spark.sparkContext.broadcast(router)  # about width * HIDDEN numbers
    filed = rows.mapInArrow(_filing(shared, width), "part int, id long, vector array<double>")
    # A part may hold a third of all rows: it is spread over many tasks by the id's digest, and no task needs a whole part.
    # Repeats of a row meet there and are dropped without another shuffle: they would take the places of other rows in a scan.
    dealt = filed.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(64))).repartition("part", "slot")
    table, _ = stored.put(dealt.dropDuplicates(["part", "slot", "id", "vector"]).select("part", "id", "vector"))
    index = Index(table, router, width, parts, parts, 1.0)
    if parts > 1:
        audit = table.select("id", "vector").orderBy(F.xxhash64("id", F.lit("audit")), "id", "vector").limit(AUDIT)
        found = search(index, audit, neighbours).toPandas()
        x = matrix((held := audit.toArrow()).column("vector").combine_chunks(), width)
        route = np.argsort(-router.scores(x), axis=1, kind="stable")
        place = {int(i): route[r].argsort() for r, i in enumerate(held.column("id").to_pylist())}
        visit = np.array([place[q][p] for q, p in zip(found["query_id"], found["part"], strict=True)])
        share = np.cumsum(np.bincount(visit, minlength=parts)) / max(1, len(visit))
        index.visits = int(np.argmax(share >= min(recall, share[-1]))) + 1
        index.recall = float(share[index.visits - 1])
    return index


class _Best:
    """The nearest rows found so far for each query, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.bound = np.full(queries, np.inf)
        self.rows = (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32))

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray, part: np.ndarray) -> None:
        q, s, i, p = (np.concatenate(x) for x in zip(self.rows, (query, score, ident, part), strict=True))
        order = np.lexsort((i, s, q))
        q, s, i, p = q[order], s[order], i[order], p[order]
        again = np.concatenate(([False], (q[1:] == q[:-1]) & (i[1:] == i[:-1]) & (s[1:] == s[:-1])))
        q, s, i, p = q[~again], s[~again], i[~again], p[~again]
        first = np.searchsorted(q, q, "left")
        rank = np.arange(len(q)) - first
        keep = rank < self.k
        last = rank == self.k - 1
        self.bound[q[last]] = s[last] ** 2
        self.rows = (q[keep], s[keep], i[keep], p[keep])


def _scan(shared, width: int, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of an index against a block of queries: the k nearest rows of this task for each query."""
        ids, x, wanted = shared.value
        square = (x**2).sum(axis=1)
        best = _Best(len(ids), k)
        for batch in batches:
            parts = batch.column("part").to_numpy()
            own = batch.column("id").to_numpy()
            y = matrix(batch.column("vector"), width)
            for p in np.unique(parts).tolist():
                asked = np.flatnonzero(wanted[:, p])
                rows = np.flatnonzero(parts == p)
                step = max(1, CELLS // max(1, len(asked)))
                for at in range(0, len(rows) if len(asked) else 0, step):
                    r = rows[at : at + step]
                    rough = square[asked, None] + (y[r] ** 2).sum(axis=1)[None] - 2 * x[asked] @ y[r].T
                    rough[ids[asked, None] == own[r][None]] = np.inf
                    slack = 1e-9 * (square[asked] + 1)
                    bound = best.bound[asked]
                    if len(r) > k:
                        bound = np.minimum(bound, np.partition(rough, k - 1, axis=1)[:, k - 1] + slack)
                    # Rough distances only choose; what is kept is measured on the vectors themselves.
                    a, b = np.nonzero((rough <= (bound + slack)[:, None]) & np.isfinite(rough))
                    for c in range(0, len(a), 500_000):
                        i, j = asked[a[c : c + 500_000]], r[b[c : c + 500_000]]
                        best.add(i, np.sqrt(((x[i] - y[j]) ** 2).sum(axis=1)), own[j], np.full(len(i), p, dtype=np.int32))
        q, s, i, p = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(i), pa.array(s), pa.array(p)], names=["query_id", "id", "score", "part"])

    return scan


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, id, score, part): the k nearest rows that the visited parts hold, for queries (id, vector).

    Nearest means the smallest Euclidean distance in double precision; ties go to the smaller id. A row with the query's
    own id is no candidate, and repeated rows count once. Queries go to the executors in blocks of ``QUERY_BLOCK``; rows of the
    index stay where they are, and each task sends back at most k rows a query.
    """
    spark = queries.sparkSession
    stored = Stored(spark, "search")
    asked, _ = stored.put(queries.select("id", "vector").distinct())
    total = asked.count()
    blocks = max(1, -(-total // (QUERY_BLOCK // 2)))
    results = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)) == block) if blocks > 1 else asked
        held = mine.toArrow()
        x = matrix(held.column("vector").combine_chunks(), index.width) if held.num_rows else np.zeros((0, max(1, index.width)))
        route = np.argsort(-index.router.scores(x), axis=1, kind="stable")[:, : index.visits] if len(x) else np.zeros((0, 1), dtype=np.int64)
        wanted = np.zeros((len(x), index.parts), dtype=bool)
        wanted[np.arange(len(x))[:, None], route] = True
        shared = spark.sparkContext.broadcast((held.column("id").to_numpy(), x, wanted))
        found = index.table.mapInArrow(_scan(shared, index.width, k), "query_id long, id long, score double, part int")
        if blocks > 1:
            found, _ = stored.put(found)
        results = found if results is None else results.union(found)
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score", "part")


def op1_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: query_id, rank, vec_id, score; queries are the rows whose vec_id is divisible by 100."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    index = build_index(vectors)
    queries = index.table.where(F.col("id") % 100 == 0).select("id", "vector")
    return search(index, queries).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
