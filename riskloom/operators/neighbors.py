"""Exact k-nearest-neighbour search as a Spark job.

Corpus rows are filed under pivots, in cells whose ball (and, in few dimensions, box) is known. A query first meets the
cell of its own nearest pivot, which bounds the distance of its k-th neighbour, and then only the cells that the bound
leaves a chance. Queries and cells meet in blocks of bounded size on both sides, so that one task never holds more than
one block pair; a block pair hands on at most k rows per query, and only such as lie within the query's bound.

Inside a block pair a cheap matrix (single precision products, or 16-bit sums for l1) with a proven error bound picks the
candidates; only their distances are computed in double precision. The cheap matrix decides nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import draw_hash
from riskloom.runtime import materialize

MAX_PIVOTS = 4096
BLOCK_ROWS = 32768
FEW_DIMENSIONS = 24  # up to here boxes are kept and cells are small
CELL_ROWS = 4096  # rows of a cell in few dimensions; in many nothing can be left out, and larger cells are handed on less often
ELEMENTS = 2_000_000  # of the matrices held at a time
TILE = (256, 2048)  # rows and columns of the cheap matrix looked at together, so that it stays in the processor's cache
SLACK = 1e-9


def _pair_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance of every row of ``a`` to the row of ``b`` at the same place."""
    out = np.empty(len(a))
    step = max(1, ELEMENTS // max(1, a.shape[1]))
    for i in range(0, len(a), step):
        gap = a[i : i + step] - b[i : i + step]
        out[i : i + step] = np.abs(gap).sum(-1) if metric == "l1" else np.sqrt((gap * gap).sum(-1))
    return out


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances of all rows of ``a`` to all rows of ``b``, one dimension at a time."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = np.abs(a[:, j, None] - b[None, :, j])
        out += gap if metric == "l1" else gap * gap
    return out if metric == "l1" else np.sqrt(out)


def _product_filter(a: np.ndarray, b: np.ndarray, sign: int) -> tuple[Callable, Callable] | None:
    """Signed squared distances without the query's own part of rows i..j of ``a`` and rows c..d of ``b``, padded to a
    multiple of eight; and for the rows' bounds the limits and twice the error."""
    middle = b.mean(0)
    a, b = a - middle, b - middle
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) or 1.0
    if not np.isfinite(scale) or scale < 1e-150 or scale > 1e150:
        return None
    a, b = a / scale, b / scale
    own, theirs = (a * a).sum(1), (b * b).sum(1)
    error = (a.shape[1] + 8) * 2.4e-7 * (own + theirs.max())
    right = np.zeros((len(b) + -len(b) % 8, b.shape[1] + 1), dtype="float32")
    right[: len(b), :-1], right[:, -1] = b, sign * 3e38
    right[: len(b), -1] = theirs
    left = sign * np.hstack([-2 * a, np.ones((len(a), 1))]).astype("float32")

    def keys(i: int, j: int, c: int, d: int):
        return left[i:j] @ right[c:d].T

    def edges(i: int, j: int, bound: np.ndarray):
        with np.errstate(over="ignore"):
            limit = np.where(np.isfinite(bound), sign * (bound / scale) ** 2 - sign * own[i:j] + error[i:j], 1e38)
        return np.minimum(limit, 1e38), 2 * error[i:j]

    return keys, edges


def _short_filter(a: np.ndarray, b: np.ndarray, sign: int) -> tuple[Callable, Callable] | None:
    """The same for l1: signed sums of absolute differences of coordinates rounded to a common grid of 16 bits."""
    low = np.minimum(a.min(0), b.min(0))
    total = (np.maximum(a.max(0), b.max(0)) - low).sum()
    width = a.shape[1]
    if not np.isfinite(total) or width > 4000:
        return None
    scale = (32000 - width) / total if total > 1e-150 else 1.0
    left = np.ascontiguousarray(np.rint((a - low) * scale).astype("int16").T)
    right = np.zeros((width, len(b) + -len(b) % 8), dtype="int16")
    right[:, : len(b)] = np.rint((b - low) * scale).T

    def keys(i: int, j: int, c: int, d: int):
        key = np.zeros((j - i, min(d, right.shape[1]) - c), dtype="int16")
        for r in range(0, j - i, 128):
            out = key[r : r + 128]
            gap = np.empty(out.shape, dtype="int16")
            for x, y in zip(left[:, i + r : min(j, i + r + 128), None], right[:, None, c:d]):
                np.subtract(x, y, out=gap)
                np.abs(gap, out=gap)
                np.add(out, gap, out=out)
        if sign < 0:
            np.negative(key, out=key)
        key[:, max(0, len(b) - c) :] = 32767
        return key

    def edges(i: int, j: int, bound: np.ndarray):
        limit = np.where(np.isfinite(bound), np.ceil(np.minimum(bound * scale, 32766)) + width + 2, 32766)
        return np.clip(limit, -32767, 32766), np.full(j - i, 2 * (width + 2))

    return keys, edges


def _hits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the few true values; rows are a multiple of eight long, and eight are looked at in one."""
    eights = np.flatnonzero(mask.reshape(-1).view("uint64"))
    at, bit = np.nonzero(mask.reshape(-1, 8)[eights])
    return np.divmod(eights[at] * 8 + bit, mask.shape[1])


def block_top(
    a: np.ndarray, b: np.ndarray, k: int, metric: str, farthest: bool = False, bound: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers in ``a`` and ``b`` and distances of the k best rows of ``b`` per row of ``a``; equal ones go to the smaller
    place in ``b``. ``bound`` limits the distances (negated for the farthest) where it is finite."""
    sign = -1 if farthest else 1
    bound = np.full(len(a), np.inf) if bound is None else bound
    cheap = (_short_filter if metric == "l1" else _product_filter)(a, b, sign)
    found = [(np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0))]
    most = ELEMENTS if cheap is None else TILE[0] * TILE[1]
    step = max(1 if cheap is None else TILE[0], most // max(1, len(b)))
    for i in range(0, len(a), step):
        j = min(len(a), i + step)
        if cheap is None:
            row, col = (x.ravel() for x in np.indices((j - i, len(b))))
        else:
            row, col = _candidates(*cheap, i, j, len(b), k, bound[i:j])
        dist = np.empty(len(row))
        for x in range(0, len(row), ELEMENTS // 8):
            part = slice(x, x + ELEMENTS // 8)
            dist[part] = _gathered(a, b, row[part] + i, col[part], metric)
        keep = ~(sign * dist > bound[i:j][row])
        row, col, dist = row[keep], col[keep], dist[keep]
        order = np.lexsort((col, sign * dist, row))
        row, col, dist = row[order], col[order], dist[order]
        first = np.searchsorted(row, np.arange(j - i))
        keep = np.arange(len(row)) - first[row] < k
        found.append((row[keep] + i, col[keep], dist[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _candidates(keys: Callable, edges: Callable, i: int, j: int, n: int, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of rows i..j with the ``n`` others that can be among a row's ``k`` best within its bound, and of few more."""
    limit, error = edges(i, j, bound)
    open_ended = np.flatnonzero(~np.isfinite(bound)) if n > k else np.empty(0, dtype=int)
    seen = min(n, max(1024, 8 * k))
    wide = max(TILE[1], seen + -seen % 8)
    found = []
    for c in range(0, n, wide):
        key = keys(i, j, c, c + wide)
        if not c and len(open_ended):
            # The k-th best of a part bounds the k-th best of all.
            edge = np.partition(key[open_ended, :seen], k - 1, axis=1)[:, k - 1] + error[open_ended]
            limit[open_ended] = np.minimum(limit[open_ended], edge)
        if not c:
            limit = np.nextafter(limit.astype("float32"), np.float32(np.inf)) if key.dtype == np.float32 else limit.astype("int16")
        row, col = _hits(key <= limit[:, None])
        found.append((row, col + c, key[row, col]))
    row, col, key = (np.concatenate(x) for x in zip(*found))
    if len(row) > 4 * k * (j - i):
        # Where a part left many, the k-th best of those bounds the k-th best of all more closely.
        order = np.lexsort((key, row))
        row, col, key = row[order], col[order], key[order].astype(float)
        first, last = np.searchsorted(row, np.arange(j - i)), np.searchsorted(row, np.arange(j - i), "right")
        full = np.flatnonzero(last - first >= k)
        edge = np.full(j - i, np.inf)
        edge[full] = np.nextafter((key[first[full] + k - 1] + error[full]).astype("float32"), np.float32(np.inf))
        keep = key <= edge[row]
        row, col = row[keep], col[keep]
    return row, col


def _gathered(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray, metric: str) -> np.ndarray:
    out = np.empty(len(row))
    step = max(1, ELEMENTS // max(1, a.shape[1]))
    for i in range(0, len(row), step):
        out[i : i + step] = _pair_distances(a[row[i : i + step]], b[col[i : i + step]], metric)
    return out


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in vectors]) if len(vectors) else np.empty((0, 0))


def nearest_neighbors(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "vec",
    metric: str = "l2",
    farthest: bool = False,
    skip_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    pivots: int | None = None,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) with the exact k nearest (or farthest) corpus rows.

    ``vec_col`` holds ``array<double>``. With ``skip_self`` a row is not its own neighbour. Ties are broken
    by id, so the result does not depend on partitioning.

    Copies of a vector are searched once: of equal corpus rows only the smallest ids can be chosen, and
    equal query rows share one answer, which is joined back afterwards.
    """
    spark = queries.sparkSession
    kind = queries.schema[id_col].dataType.simpleString()
    result = f"query_id {kind}, neighbor_id {kind}, distance double, rank int"
    need = k + (1 if skip_self else 0)
    q_all = _keyed(queries, id_col, vec_col)
    distinct = materialize(q_all.groupBy("h", "vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "distinct")
    copies = distinct.agg(F.max("n")).first()[0]
    if copies is None:
        return spark.createDataFrame([], result)
    # Spark cuts to `need` rows per vector and task before the shuffle, however many copies there are
    same = Window.partitionBy("h", "vec").orderBy("id")
    c = _keyed(corpus, id_col, vec_col).withColumn("r", F.row_number().over(same)).where(F.col("r") <= need)
    c = materialize(c.select("id", "vec"), "vectors")
    found = _search(distinct.select("id", "vec"), c, need, metric, farthest, block_rows, pivots)
    if copies > 1:
        answers = found.groupBy("query_id").agg(
            F.sort_array(F.collect_list(F.struct("rank", "neighbor_id", "distance"))).alias("a")
        )  # at most `need` entries per query
        answers = materialize(distinct.join(answers, distinct["id"] == answers["query_id"]).select("h", "vec", "a"), "answers")
        found = q_all.join(answers, ["h", "vec"]).select(F.col("id").alias("query_id"), F.inline("a"))
    if skip_self:
        ahead = F.max(F.when(F.col("neighbor_id") == F.col("query_id"), F.col("rank"))).over(Window.partitionBy("query_id"))
        found = found.withColumn("own", ahead).where(F.col("neighbor_id") != F.col("query_id"))
        found = found.withColumn("rank", F.col("rank") - F.coalesce((F.col("rank") > F.col("own")).cast("int"), F.lit(0)))
    return found.where(F.col("rank") <= k).select("query_id", "neighbor_id", "distance", F.col("rank").cast("int").alias("rank"))


def _keyed(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, h): the digest is compared before the vector and keeps sorts cheap."""
    vec = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).alias("id"), vec.alias("vec"), F.xxhash64(vec).alias("h"))


@dataclass
class Cells:
    """Pivots with what is known of their rows; several neighbouring cells may be visited as one (``group``)."""

    pivots: np.ndarray
    radius: np.ndarray
    size: np.ndarray
    group: np.ndarray
    box: tuple[np.ndarray, np.ndarray] | None = None

    def home(self, x: np.ndarray) -> np.ndarray:
        """A near pivot of every row that has rows itself; which one does not matter to the answers."""
        out = np.empty(len(x), dtype="int32")
        own = np.where(self.size > 0, (self.pivots * self.pivots).sum(1), np.inf)
        step = max(1, ELEMENTS // len(own))
        for i in range(0, len(x), step):
            out[i : i + step] = np.argmin(own - 2 * (x[i : i + step] @ self.pivots.T), axis=1)
        return out

    def within(self, x: np.ndarray, bound: np.ndarray, metric: str, farthest: bool) -> Iterator[np.ndarray]:
        """Per row the groups that hold a cell with a chance to reach the bound."""
        order = np.argsort(self.group, kind="stable")
        names, starts = np.unique(self.group[order], return_index=True)
        step = max(1, ELEMENTS // len(order))
        for i in range(0, len(x), step):
            part, limit = x[i : i + step], bound[i : i + step]
            key = self._reach(part, metric, farthest)
            near = (key <= (limit + SLACK * (1 + np.abs(limit)))[:, None]) & (self.size > 0)[None, :]
            for row in np.logical_or.reduceat(near[:, order], starts, axis=1):
                yield names[row].astype("int32")

    def _to_pivots(self, x: np.ndarray, metric: str, farthest: bool) -> np.ndarray:
        """Distances of rows to pivots that are never too great (for the farthest: too small), from one product where that is safe."""
        if metric != "l1":
            with np.errstate(over="ignore", invalid="ignore"):
                lengths = (x * x).sum(1)[:, None] + (self.pivots * self.pivots).sum(1)
                error = (x.shape[1] + 8) * 4.5e-16 * lengths
                square = lengths - 2 * (x @ self.pivots.T) + (error if farthest else -error)
            if np.isfinite(square).all():
                return np.sqrt(np.maximum(square, 0))
        return _distances(x, self.pivots, metric)

    def _reach(self, x: np.ndarray, metric: str, farthest: bool) -> np.ndarray:
        """Bound of the distance to any row of a cell: the least one, or the greatest one negated."""
        if self.box is None:
            d = self._to_pivots(x, metric, farthest)
            slack = SLACK * (1 + self.radius + d)
            return -(d + self.radius + slack) if farthest else d - self.radius - slack
        low, high = self.box
        out = np.zeros((len(x), len(low)))
        for j in range(x.shape[1]):
            under, over = low[None, :, j] - x[:, j, None], x[:, j, None] - high[None, :, j]
            gap = np.maximum(np.abs(under), np.abs(over)) if farthest else np.maximum(np.maximum(under, over), 0)
            out += gap if metric == "l1" else gap * gap
        out = out if metric == "l1" else np.sqrt(out)
        return -out * (1 + SLACK) if farthest else out * (1 - SLACK)


def cell_rows_for(rows: int, width: int, block_rows: int = BLOCK_ROWS) -> int:
    """Rows of a cell that suit a search: small in few dimensions; in many some sixteen cells, as large as a block at most."""
    return CELL_ROWS if width <= FEW_DIMENSIONS else min(block_rows, max(2048, rows // 16))


def describe_cells(filed: DataFrame, pivots: np.ndarray) -> Cells:
    """What is known of the cells of a table (vec, cell, far)."""
    width = pivots.shape[1]
    ends = [f(F.col("vec")[j]).alias(f"{n}{j}") for n, f in (("low", F.min), ("high", F.max)) for j in range(width)] if width <= FEW_DIMENSIONS else []
    rows = filed.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n"), *ends).collect()  # one row per pivot
    radius, size = np.full(len(pivots), -1.0), np.zeros(len(pivots), dtype="int64")
    low, high = np.zeros(pivots.shape), np.zeros(pivots.shape)
    for r in rows:
        radius[r["cell"]], size[r["cell"]] = r["radius"], r["n"]
        if ends:
            low[r["cell"]], high[r["cell"]] = [r[f"low{j}"] for j in range(width)], [r[f"high{j}"] for j in range(width)]
    return Cells(pivots, radius, size, np.arange(len(pivots)), (low, high) if ends else None)


def file_rows(rows: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """``rows`` (vec and others) with ``cell``, a near pivot, and ``far``, the distance to it."""
    blank = Cells(pivots, np.zeros(len(pivots)), np.ones(len(pivots)), np.arange(len(pivots)))

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = _stack(pdf["vec"])
                cell = blank.home(x)
                yield pdf.assign(cell=cell, far=_pair_distances(x, pivots[cell], metric))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(file, f"{kinds}, cell int, far double")


def _search(
    q: DataFrame, c: DataFrame, need: int, metric: str, farthest: bool, block_rows: int, pivots: int | None
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) with the ``need`` best corpus rows per query row (id, vec)."""
    spark = q.sparkSession
    kind = q.schema["id"].dataType.simpleString()
    n_corpus = c.count()
    if n_corpus == 0:
        return spark.createDataFrame([], f"query_id {kind}, neighbor_id {kind}, distance double, rank int")
    width = c.select(F.size("vec")).first()[0]
    m = pivots or min(MAX_PIVOTS, max(1, n_corpus // cell_rows_for(n_corpus, width, block_rows)))
    picked = c.orderBy(draw_hash("pivot", F.col("id"))).limit(m).collect()
    centers = np.array([r["vec"] for r in picked], dtype=float)
    filed = materialize(file_rows(c.withColumn("y", F.lit(0)), centers, metric), "corpus")
    cells = describe_cells(filed, centers)
    return search_cells(q, cells, lambda _: filed, need, metric, farthest, block_rows).drop("y")


def search_cells(
    queries: DataFrame, cells: Cells, rows_of: Callable[[list[int]], DataFrame], k: int, metric: str, farthest: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, neighbor_id, distance, y, rank): the k best rows of all cells per query (id, vec).

    ``rows_of`` gives the rows (id, vec, y, cell) of some cells at least.
    """
    kind = queries.schema["id"].dataType.simpleString()
    sign = -1 if farthest else 1

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=cells.group[cells.home(_stack(pdf["vec"]))].astype("int32"))

    home = materialize(queries.select("id", "vec").mapInPandas(own, f"id {kind}, vec array<double>, cell int"), "home")
    first = _visit(home.withColumn("bound", F.lit(math.inf)), cells, rows_of, k, metric, farthest, block_rows)
    first = materialize(first, "first")
    last = F.max(F.when(F.col("rank") == k, sign * F.col("distance"))).alias("bound")
    bounds = first.groupBy("query_id").agg(last)
    reach = home.join(bounds, F.col("id") == F.col("query_id"), "left").select("id", "vec", "cell", F.coalesce("bound", F.lit(math.inf)).alias("bound"))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                lists = cells.within(_stack(pdf["vec"]), pdf["bound"].to_numpy(), metric, farthest)
                yield pdf.drop(columns="cell").assign(cells=[x[x != mine] for x, mine in zip(lists, pdf["cell"])])

    visits = materialize(reach.mapInPandas(others, f"id {kind}, vec array<double>, bound double, cells array<int>"), "visits")
    visits = visits.select("id", "vec", "bound", F.explode("cells").alias("cell"))
    more = _visit(visits, cells, rows_of, k, metric, farthest, block_rows)
    return _ranked(first.drop("rank").unionByName(more.drop("rank")), k, farthest)


def _visit(
    visits: DataFrame, cells: Cells, rows_of: Callable[[list[int]], DataFrame], k: int, metric: str, farthest: bool, block_rows: int
) -> DataFrame:
    """The k best rows per query in the groups of cells it visits (id, vec, bound, cell); both sides meet in blocks."""
    spark = visits.sparkSession
    kind = visits.schema["id"].dataType.simpleString()
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per group
    held = np.bincount(cells.group, weights=cells.size, minlength=len(cells.group))
    plan = [(g, math.ceil(n / block_rows), max(1, math.ceil(held[g] / block_rows))) for g, n in asked.items()]
    wanted = [int(c) for c in np.flatnonzero(np.isin(cells.group, list(asked)) & (cells.size > 0))]
    sides = F.broadcast(spark.createDataFrame(plan, "cell int, qblocks int, cblocks int"))  # at most one row per pivot
    groups = F.broadcast(spark.createDataFrame([(c, int(cells.group[c])) for c in wanted], "cell int, grp int"))
    rows = rows_of(wanted).join(groups, "cell").select(F.col("grp").alias("cell"), "id", "vec", "y")
    keys = ["cell", "cblock", "qblock"]
    left = (
        visits.join(sides, "cell")
        .withColumn("qblock", F.pmod(F.xxhash64("id"), F.col("qblocks")).cast("int"))
        .withColumn("cblock", F.explode(F.sequence(F.lit(0), F.col("cblocks") - 1)))
        .select(*keys, "id", "vec", "bound")
    )
    right = (
        rows.join(sides, "cell")
        .withColumn("cblock", F.pmod(F.xxhash64("id"), F.col("cblocks")).cast("int"))
        .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)))
        .select(*keys, "id", "vec", "y")
    )

    def meet(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(cs):
            return pd.DataFrame({"query_id": [], "neighbor_id": [], "distance": [], "y": []})
        ids = cs["id"].to_numpy()
        order = np.argsort(ids, kind="stable")  # texts compare by code point, as in Spark
        row, col, dist = block_top(_stack(qs["vec"]), _stack(cs["vec"])[order], k, metric, farthest, qs["bound"].to_numpy())
        col = order[col]
        return pd.DataFrame({"query_id": qs["id"].to_numpy()[row], "neighbor_id": ids[col], "distance": dist, "y": cs["y"].to_numpy()[col]})

    # A number of partitions of its own: few bytes are much work here, and by bytes they would be put together.
    pairs = sum(q * c for _, q, c in plan)
    parts = max(1, min(pairs, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    met = (
        left.repartition(parts, *keys).groupBy(*keys)
        .cogroup(right.repartition(parts, *keys).groupBy(*keys))
        .applyInPandas(meet, f"query_id {kind}, neighbor_id {kind}, distance double, y int")
    )
    return _ranked(met, k, farthest)


def _ranked(pairs: DataFrame, k: int, farthest: bool) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.col("distance").desc() if farthest else F.col("distance").asc(), "neighbor_id")
    return pairs.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)


def mean_distance(neighbors: DataFrame) -> DataFrame:
    """Average distance of each query row to its neighbours found."""
    return neighbors.groupBy("query_id").agg(F.avg("distance").alias("mean_distance"))


def vote_share(weights: str) -> Column:
    """Share of class 1 among votes (y, distance); with ``distance`` a vote weighs 1/distance and one at distance 0 outvotes all others."""
    if weights == "uniform":
        return F.avg("y")
    exact = F.count(F.when(F.col("distance") == 0, 1))
    exact_yes = F.sum(F.when(F.col("distance") == 0, F.col("y")).otherwise(0.0))
    pull = F.when(F.col("distance") > 0, 1 / F.col("distance")).otherwise(0.0)
    return F.when(exact > 0, exact_yes / exact).otherwise(F.sum(F.col("y") * pull) / F.sum(pull))


def knn_vote(
    train: DataFrame,
    test: DataFrame,
    label: str,
    k: int = 5,
    weights: str = "uniform",
    p: int = 2,
    id_col: str = "id",
    vec_col: str = "vec",
    skip_self: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Probability of class 1 per test row from its k nearest training rows.

    ``weights='distance'`` weighs a vote by 1/distance; a neighbour at distance 0 outvotes all others.
    """
    metric = "l1" if p == 1 else "l2"
    near = nearest_neighbors(test, train, k, id_col, vec_col, metric, skip_self=skip_self, block_rows=block_rows)
    labels = train.select(F.col(id_col).alias("neighbor_id"), F.col(label).cast("double").alias("y"))
    votes = near.join(labels, "neighbor_id")
    prob = vote_share(weights)
    out = votes.groupBy(F.col("query_id").alias(id_col)).agg(prob.alias("y_prob"))
    return out.withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))
