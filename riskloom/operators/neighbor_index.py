"""A neighbour index that is written once and read in part: cells as partitions of a table.

In few dimensions a tree cut from a sample deals the rows out to cells, and a search goes down this tree. A query meets the rows of its own
cell, which bound the distance of its k-th neighbour; a query whose bound reaches into no other cell's box is answered in that task, and
only the others are handed to the cells they reach. In many dimensions rows are filed under their nearest pivot, and a search looks at
the cells that the triangle inequality leaves a chance. Files of other cells are never opened. Answers are exact; equal distances go to
the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from riskloom.functions.hashing import draw_hash
from riskloom.operators import neighbors
from riskloom.operators.neighbor_tree import CellTree, cell_top
from riskloom.operators.neighbors import Cells, vote_share
from riskloom.runtime import attach_small, materialize, scratch_path

MOST_PIVOTS = 4096
CELL_ROWS = 4096
BLOCK_ROWS = 2048
SAMPLE_ROWS = 16  # sampled rows per cell that a tree is cut from
TASK_ROWS = 250_000  # queries that a task of a search is given, about


class NeighborIndex:
    """Cells of a labelled table (id, vec, y) under ``path``: ``rows`` partitioned by cell, ``cells`` with pivot, radius and size."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        cells = sorted(spark.read.parquet(f"{path}/cells").collect(), key=lambda r: r["cell"])  # one row per pivot
        self.pivots = np.array([r["pivot"] for r in cells], dtype=float)
        self.radius = np.array([r["radius"] for r in cells])
        self.size = np.array([r["n"] for r in cells])
        self.p = cells[0]["p"] if cells else 2
        # An index written before boxes were kept has none.
        boxed = bool(cells) and "low" in cells[0] and cells[0]["low"] is not None
        self.box = tuple(np.array([r[n] for r in cells], dtype=float) for n in ("low", "high")) if boxed else None
        # Nor has one written before trees were kept, or in many dimensions, a way to its cells.
        grown = boxed and "way" in cells[0] and cells[0]["way"] is not None
        self.tree = CellTree.from_ways([r["way"] for r in cells]).with_boxes(*self.box, self.size) if grown else None

    @classmethod
    def build(cls, rows: DataFrame, p: int = 2, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS, path: str | None = None) -> NeighborIndex:
        """Index a table (id string, vec array<double>, y int); at least one row is needed."""
        spark = rows.sparkSession
        path = path or scratch_path(spark, "neighborindex")
        n = rows.count()
        if not n:
            raise ValueError("no rows to index")
        many = min(MOST_PIVOTS, max(1, n // cell_rows))
        rows, metric = rows.select("id", "vec", "y"), "l1" if p == 1 else "l2"
        tree = None
        if rows.select(F.size("vec")).first()[0] <= neighbors.FEW_DIMENSIONS:
            sample = rows.orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS * many).select("vec").collect()
            tree, pivots = CellTree.grow(np.array([r["vec"] for r in sample], dtype=float), many)
            filed = _file(rows, tree, pivots, metric)
        else:
            # Equal vectors make one pivot.
            picked = rows.groupBy("vec").agg(F.min(draw_hash("pivot", F.col("id"))).alias("h")).orderBy("h").limit(many).collect()
            pivots = np.array([r["vec"] for r in picked], dtype=float)
            filed = neighbors.file_rows(rows, pivots, metric)
        filed = materialize(filed, "filed")
        known = neighbors.describe_cells(filed, pivots)
        low, high = (x.tolist() for x in known.box) if known.box else ([None] * len(pivots),) * 2
        ways = tree.ways() if tree is not None else [None] * len(pivots)
        table = [(c, pivots[c].tolist(), float(known.radius[c]), int(known.size[c]), p, low[c], high[c], ways[c]) for c in range(len(pivots))]
        cells = spark.createDataFrame(
            table, "cell int, pivot array<double>, radius double, n long, p int, low array<double>, high array<double>, way array<struct<feature:int,cut:double,side:int>>"
        )
        cells.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
        blocks = cells.select("cell", F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1)).cast("int").alias("blocks"))
        laid = filed.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        # Cell and block together deal out a hot cell; a file holds rows of one cell.
        laid.select("cell", "block", "id", "vec", "y").repartition("cell", "block").write.partitionBy("cell").mode("overwrite").parquet(f"{path}/rows")
        return cls(spark, path)

    def save(self, path: str) -> None:
        self._rows().write.partitionBy("cell").mode("overwrite").parquet(f"{path}/rows")
        self.spark.read.parquet(f"{self.path}/cells").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")

    def _rows(self) -> DataFrame:
        return self.spark.read.schema("block int, id string, vec array<double>, y int, cell int").parquet(f"{self.path}/rows")

    def rows_of(self, cells: list[int]) -> DataFrame:
        """The rows of some cells; other cells' files are not listed among the inputs."""
        return self._rows().where(F.col("cell").isin([int(c) for c in cells]))

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, neighbor_id, distance, y, rank): the k nearest rows of every query (id string, vec array<double>)."""
        if self.tree is None:
            return neighbors.search_cells(self._asked(queries), self.cells(), self.rows_of, k, "l1" if self.p == 1 else "l2")
        first, more = self._visits(queries, k)
        return _listed(first.where("NOT open")).unionByName(neighbors._ranked(more, k, False))

    def vote(self, queries: DataFrame, k: int, weights: str = "uniform") -> DataFrame:
        """(id, y_prob, y_pred) by the votes of the k nearest rows."""
        if self.tree is None:
            votes, answered = self.search(queries, k), None
        else:
            first, more = self._visits(queries, k, weights)
            votes, answered = neighbors._ranked(more, k, False), first.where("NOT open").select("id", "y_prob")
        votes = votes.withColumn("y", F.col("y").cast("double"))
        out = votes.groupBy(F.col("query_id").alias("id")).agg(vote_share(weights).alias("y_prob"))
        if answered is not None:
            out = answered.unionByName(out)
        return out.withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))

    def cells(self) -> Cells:
        """The cells for a search; those much smaller than suits it are visited together with their neighbours."""
        cells = Cells(self.pivots, self.radius, self.size, np.arange(len(self.pivots)), self.box)
        rows = int(self.size.sum())
        groups = max(1, rows // neighbors.cell_rows_for(rows, self.pivots.shape[1]))
        if len(self.pivots) < 2 * groups:
            return cells
        seeds = self.pivots[:: len(self.pivots) // groups]
        blank = Cells(seeds, np.zeros(len(seeds)), np.ones(len(seeds)), np.arange(len(seeds)))
        return replace(cells, group=blank.home(self.pivots))

    @staticmethod
    def _asked(queries: DataFrame) -> DataFrame:
        return queries.select(F.col("id").cast("string").alias("id"), F.col("vec").cast("array<double>").alias("vec")).where("vec IS NOT NULL")

    def _visits(self, queries: DataFrame, k: int, weights: str | None = None) -> tuple[DataFrame, DataFrame]:
        """What every query finds in its own cell, stored; and for the queries left open all they find, k rows of each part at most.

        Open are queries whose bound reaches into other parts, and ids that come more than once, as they share an answer. With ``weights`` the
        others have a vote (``y_prob``) instead of rows.
        """
        asked = self._asked(queries)
        twice = asked.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("twice"))
        asked = attach_small(asked, twice, ["id"]).select("id", "vec", F.coalesce("twice", F.col("id").isNull()).alias("twice"))
        parts = self._parts(k)
        metric = "l1" if self.p == 1 else "l2"
        shared = asked.sparkSession.sparkContext.broadcast((self.tree, _Parts(parts.first, parts.many)))

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, parts = shared.value
            for batch in batches:
                if batch.num_rows:
                    cell = tree.home(_vectors(batch.column("vec")))
                    digest = batch.column("digest").to_numpy().view(np.uint64)
                    part = parts.first[cell] + (digest % parts.many[cell].astype(np.uint64)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(part.astype(np.int32))], ["id", "vec", "twice", "part"])

        home = asked.withColumn("digest", F.xxhash64("id")).mapInArrow(own, "id string, vec array<double>, twice boolean, part int")

        def meet(qs: pa.Table, cs: pa.Table) -> pa.Table:
            tree, parts = shared.value
            x = _vectors(qs["vec"])
            start, ids, dist, y = _nearest(x, cs, k, metric, np.full(len(x), np.inf))
            bound = np.full(len(x), np.inf)
            full = np.flatnonzero(np.diff(start) == k)
            bound[full] = dist[start[full] + k - 1]
            others, at = parts.others(tree, x, bound, metric, qs["part"].to_numpy())
            times = np.diff(start)
            open_ = qs["twice"].to_numpy() | (np.diff(at) > 0) | (times == 0)
            share = np.full(len(x), np.nan)
            if weights is not None:
                share = np.where(open_, np.nan, _shares(start, dist, y, weights))
                kept, start = np.repeat(open_, times), np.concatenate([[0], np.cumsum(np.where(open_, times, 0))])
                ids, dist, y = ids.filter(pa.array(kept)), dist[kept], y.filter(pa.array(kept))
            vec = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(open_, x.shape[1], 0))]), pa.int32()), pa.array(x[open_].ravel()))
            lists = [pa.ListArray.from_arrays(pa.array(start, pa.int32()), v) for v in (ids, pa.array(dist), y)]
            parts_of = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(others.astype(np.int32)))
            columns = [qs["id"], pa.array(open_), vec, pa.array(bound), parts_of, *lists, pa.array(share, mask=np.isnan(share))]
            return pa.Table.from_arrays(columns, ["id", "open", "vec", "bound", "others", "neighbor_id", "distance", "y", "y_prob"])

        found = "id string, open boolean, vec array<double>, bound double, others array<int>, neighbor_id array<string>, distance array<double>, y array<int>, y_prob double"
        first = materialize(self._met(home, parts, meet, found), "first")
        open_ = first.where("open")
        reached = open_.select("id", "vec", "bound", F.explode("others").alias("part"))

        def meet_others(qs: pa.Table, cs: pa.Table) -> pa.Table:
            x = _vectors(qs["vec"])
            start, ids, dist, y = _nearest(x, cs, k, metric, qs["bound"].to_numpy())
            query = qs["id"].take(pa.array(np.repeat(np.arange(len(x)), np.diff(start))))
            return pa.Table.from_arrays([query, ids, pa.array(dist), y], ["query_id", "neighbor_id", "distance", "y"])

        more = self._met(reached, parts, meet_others, "query_id string, neighbor_id string, distance double, y int")
        return first, _listed(open_).drop("rank").unionByName(more)

    def _parts(self, k: int) -> _Parts:
        """A cell is one part unless it holds more than a block, which a tree leaves only where many rows are equal (or its sample missed a heap):
        there only the smallest ids of equal rows can be chosen, and what is left is dealt out to parts.
        """
        most = neighbors.BLOCK_ROWS
        large = np.flatnonzero(self.size > most).tolist()
        many, heaps = np.ones(len(self.size), np.int64), None
        if large:
            same = Window.partitionBy("cell", F.xxhash64("vec"), "vec").orderBy("id")
            heaps = self.rows_of(large).select("id", "vec", "y", "cell", F.row_number().over(same).alias("r")).where(F.col("r") <= k).drop("r")
            heaps = materialize(heaps, "heaps")
            for r in heaps.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per large cell
                many[r["cell"]] = math.ceil(r["n"] / most)
        return _Parts(np.cumsum(many) - many, many, set(large), heaps)

    def _rows_of_parts(self, parts: _Parts, asked: list[int]) -> DataFrame:
        """The rows (id, vec, y, part) of the cells of some parts."""
        cells = np.unique(np.searchsorted(parts.first, asked, side="right") - 1).tolist()
        columns = ["id", "vec", "y", "cell"]
        rows = self.rows_of([c for c in cells if c not in parts.large]).select(*columns)
        if parts.heaps is not None:
            rows = rows.unionByName(parts.heaps.select(*columns))
        table = F.broadcast(self.spark.createDataFrame([(c, int(parts.first[c]), int(parts.many[c])) for c in cells], "cell int, first int, many int"))
        part = F.col("first") + F.pmod(F.xxhash64("id", F.lit(1)), F.col("many"))
        return rows.join(table, "cell").select("id", "vec", "y", part.cast("int").alias("part"))

    def _met(self, queries: DataFrame, parts: _Parts, meet: Callable[[pa.Table, pa.Table], pa.Table], found: str) -> DataFrame:
        """``meet`` of the queries (.., part) and the rows of every part; the queries of a part come in blocks of bounded size."""
        spark = queries.sparkSession
        asked = {r["part"]: r["n"] for r in queries.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per part
        if not asked:
            return spark.createDataFrame([], found)
        plan = [(p, math.ceil(n / neighbors.BLOCK_ROWS)) for p, n in asked.items()]
        sides = F.broadcast(spark.createDataFrame(plan, "part int, blocks int"))
        left = queries.join(sides, "part").withColumn("block", F.pmod(F.xxhash64("id", "vec", F.lit(2)), F.col("blocks")).cast("int")).drop("blocks")
        right = self._rows_of_parts(parts, list(asked)).join(sides, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        # A number of partitions of its own: few bytes are much work here, and by bytes they would be put together.
        least = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        many = min(sum(b for _, b in plan), max(least, sum(asked.values()) // TASK_ROWS))
        keys = ["part", "block"]

        def both(qs: pa.Table, cs: pa.Table) -> pa.Table:
            return meet(qs, cs) if len(qs) else to_arrow_schema(StructType.fromDDL(found)).empty_table()

        return left.repartition(many, *keys).groupBy(*keys).cogroup(right.repartition(many, *keys).groupBy(*keys)).applyInArrow(both, found)


@dataclass
class _Parts:
    """Per cell its first part and how many it has; the cells larger than a block, and the rows of these that can be chosen."""

    first: np.ndarray
    many: np.ndarray
    large: set[int] = field(default_factory=set)
    heaps: DataFrame | None = None

    def others(self, tree: CellTree, x: np.ndarray, bound: np.ndarray, metric: str, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts within the bounds of rows, but for the row's own, one row after another; and where each row's begin."""
        row, cell = tree.within(x, bound, metric)
        times = self.many[cell]
        row, part = np.repeat(row, times), np.repeat(self.first[cell] - np.cumsum(times) + times, times) + np.arange(times.sum())
        keep = part != mine[row]
        return part[keep], np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(x)))])


def _vectors(column) -> np.ndarray:
    """Rows of an Arrow list column as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), -1)


def _file(rows: DataFrame, tree: CellTree, pivots: np.ndarray, metric: str) -> DataFrame:
    """``rows`` (id, vec, y) with ``cell`` and ``far``, the distance to the cell's pivot."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("vec"))
                cell = tree.home(x)
                far = neighbors._pair_distances(x, pivots[cell], metric)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], ["id", "vec", "y", "cell", "far"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(file, f"{kinds}, cell int, far double")


def _nearest(x: np.ndarray, cs: pa.Table, k: int, metric: str, bound: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, pa.Array]:
    """The k nearest rows (id, vec, y) of every query within its bound, as (where each query's begin, ids, distances, ys)."""
    if not len(cs):
        return np.zeros(len(x) + 1, np.int64), pa.array([], pa.string()), np.empty(0), pa.array([], pa.int32())
    ids = cs["id"].combine_chunks()
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy()  # by bytes, as in Spark
    row, col, dist = cell_top(x, _vectors(cs["vec"])[order], k, metric, bound)
    at = pa.array(order[col])
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))]), ids.take(at), dist, cs["y"].combine_chunks().take(at)


def _shares(start: np.ndarray, dist: np.ndarray, y: pa.Array, weights: str) -> np.ndarray:
    """``vote_share`` of the votes of every query; votes without a class count as there."""
    y = y.to_numpy(zero_copy_only=False).astype(float)
    query, many, known = np.repeat(np.arange(len(start) - 1), np.diff(start)), len(start) - 1, ~np.isnan(y)
    y = np.where(known, y, 0.0)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(query, values, many)

    with np.errstate(divide="ignore", invalid="ignore"):
        if weights == "uniform":
            return total(y) / total(known)
        exact, pull = dist == 0, np.where(dist > 0, 1 / dist, 0.0)
        share = np.where(total(exact) > 0, total(y * exact) / total(exact), np.where(total(known) > 0, total(y * pull) / total(pull), np.nan))
        return np.where((total(exact) > 0) & (total(~exact | known) == 0), np.nan, share)


def _listed(found: DataFrame) -> DataFrame:
    """(query_id, neighbor_id, distance, y, rank), one row per neighbour."""
    each = F.posexplode(F.arrays_zip("neighbor_id", "distance", "y"))
    return found.select(F.col("id").alias("query_id"), each.alias("at", "one")).select(
        "query_id", "one.neighbor_id", "one.distance", "one.y", (F.col("at") + 1).alias("rank")
    )
