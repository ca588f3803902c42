"""Queries for neighbour search and class resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import neighbors, sampling
from riskloom.operators.neighbor_index import NeighborIndex
from riskloom.plans import data
from riskloom.plans.catalog_drift import draw_sql
from riskloom.plans.registry import query

P = f"WITH p AS ({data.POINTS_SQL})"


def _points(spark, d):
    return data.points(spark, d).withColumn("id", F.col("id").cast("string"))


def knn_sql(a: str, b: str, k: int, order: str = "", skip_self: bool = True, distance: str = "list_distance(q.vec, c.vec)", id_type: str = "VARCHAR") -> str:
    skip = "WHERE q.id <> c.id" if skip_self else ""
    return f"""SELECT * FROM (SELECT q.id::{id_type} AS query_id, c.id::{id_type} AS neighbor_id, {distance} AS distance,
      row_number() OVER (PARTITION BY q.id ORDER BY {distance} {order}, c.id::{id_type}) AS rank FROM {a} q, {b} c {skip}) WHERE rank <= {k}"""


def _near(df):
    return df.select("query_id", "neighbor_id", F.round("distance", 6).alias("distance"), "rank")


@query("nearest_neighbors", f"{P}, n AS ({knn_sql('p', 'p', 5, id_type='BIGINT')}) SELECT query_id, neighbor_id, round(distance, 6) AS distance, rank FROM n")
def nearest_neighbors(spark, d):
    df = data.points(spark, d)
    return _near(neighbors.nearest_neighbors(df, df, 5, skip_self=True))


L1 = "list_sum(list_transform(list_zip(q.vec, c.vec), lambda z: abs(z[1] - z[2])))"


@query(
    "nearest_neighbors_l1",
    f"{P}, n AS ({knn_sql('p', '(SELECT * FROM p WHERE y = 1)', 3, distance=L1, id_type='BIGINT')}) SELECT query_id, neighbor_id, round(distance, 6) AS distance, rank FROM n",
)
def nearest_neighbors_l1(spark, d):
    df = data.points(spark, d)
    return _near(neighbors.nearest_neighbors(df, df.where("y = 1"), 3, metric="l1", skip_self=True))


@query(
    "farthest_neighbors",
    f"{P}, n AS ({knn_sql('(SELECT * FROM p WHERE y = 0)', '(SELECT * FROM p WHERE y = 1)', 3, 'DESC', id_type='BIGINT')}) SELECT query_id, neighbor_id, round(distance, 6) AS distance, rank FROM n",
)
def farthest_neighbors(spark, d):
    df = data.points(spark, d)
    return _near(neighbors.nearest_neighbors(df.where("y = 0"), df.where("y = 1"), 3, farthest=True))


@query(
    "knn_vote",
    f"{P}, n AS ({knn_sql('p', 'p', 7, id_type='BIGINT')}) SELECT query_id AS id, round(avg(y), 6) AS y_prob, (avg(y) > 0.5)::INT AS y_pred FROM n JOIN p ON neighbor_id = p.id GROUP BY query_id",
)
def knn_vote(spark, d):
    df = data.points(spark, d)
    out = neighbors.knn_vote(df, df, "y", 7, skip_self=True)
    return out.select("id", F.round("y_prob", 6).alias("y_prob"), "y_pred")


@query(
    "knn_weighted_vote",
    f"""{P}, n AS ({knn_sql('p', 'p', 9, distance=L1, id_type='BIGINT')})
    SELECT query_id AS id, round(sum(y / distance) / sum(1 / distance), 6) AS y_prob FROM n JOIN p ON neighbor_id = p.id GROUP BY query_id""",
)
def knn_weighted_vote(spark, d):
    df = data.points(spark, d)
    out = neighbors.knn_vote(df, df, "y", 9, "distance", p=1, skip_self=True)
    return out.select("id", F.round("y_prob", 6).alias("y_prob"))


@query(
    "knn_vote_indexed",
    f"""{P}, n AS ({knn_sql('p', 'p', 7, skip_self=False)})
    SELECT query_id AS id, round(avg(y), 6) AS y_prob, (avg(y) > 0.5)::INT AS y_pred FROM n JOIN p ON neighbor_id = p.id::VARCHAR GROUP BY query_id""",
)
def knn_vote_indexed(spark, d):
    """Every row's vote, its own included, from an index written once."""
    df = _points(spark, d).select("id", F.col("vec").cast("array<double>").alias("vec"), F.col("y").cast("int").alias("y"))
    out = NeighborIndex.build(df, cell_rows=100).vote(df, 7)
    return out.select("id", F.round("y_prob", 6).alias("y_prob"), "y_pred")


SMOTE = f"""{P}, few AS (SELECT * FROM p WHERE y = 1), sizes AS (SELECT count(*) FILTER (y = 1) AS a, count(*) FILTER (y = 0) AS b FROM p),
near AS ({knn_sql('few', 'few', 5)}),
share AS (SELECT id::VARCHAR AS id, vec, row_number() OVER (ORDER BY md5('1:share:' || id)) AS place FROM few),
times AS (SELECT id, vec, (b - a) // a + CASE WHEN place <= (b - a) % a THEN 1 ELSE 0 END AS t FROM share, sizes),
draws AS (SELECT id, vec, unnest(range(t)) AS copy FROM times WHERE t > 0),
picks AS (SELECT id, vec, copy, CAST(floor({draw_sql("'1:which:' || id || ':' || copy")} * 5) AS INT) + 1 AS rank,
          {draw_sql("'1:gap:' || id || ':' || copy")} AS gap FROM draws),
made AS (SELECT picks.id || '~' || copy AS id, 1 AS y, list_transform(list_zip(picks.vec, few.vec), lambda z: z[1] + gap * (z[2] - z[1])) AS vec
         FROM picks JOIN near ON picks.id = near.query_id AND picks.rank = near.rank JOIN few ON few.id::VARCHAR = near.neighbor_id),
allp AS (SELECT id::VARCHAR AS id, y, vec FROM p UNION ALL SELECT id, y, vec FROM made)"""

SHOWN = "id, y, round(vec[1], 6) AS first, round(list_sum(vec), 6) AS total"


def _shown(df):
    return df.select("id", "y", F.round(F.col("vec")[0], 6).alias("first"), F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("smote", SMOTE + f" SELECT {SHOWN} FROM allp")
def smote(spark, d):
    return _shown(sampling.smote(_points(spark, d), "y", "id"))


@query(
    "smote_ratio",
    f"{P} SELECT y, CASE WHEN y = 0 THEN count(*) ELSE CAST(floor((SELECT count(*) FROM p WHERE y = 0) * 0.7e0) AS BIGINT) END AS n FROM p GROUP BY y",
)
def smote_ratio(spark, d):
    return sampling.smote(_points(spark, d), "y", "id", ratio=0.7).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


def _near_miss_sql(version: int) -> str:
    many = "(SELECT * FROM p WHERE y = 0)"
    few = "(SELECT * FROM p WHERE y = 1)"
    first = ""
    if version == 3:
        first = f", f AS ({knn_sql(few, many, 3)}), m3 AS (SELECT * FROM p WHERE y = 0 AND id::VARCHAR IN (SELECT neighbor_id FROM f))"
        many = "m3"
    order = "DESC" if version == 2 else ""
    pick = "DESC" if version == 3 else ""
    return f"""{P}{first}, n AS ({knn_sql(many, few, 3, order)}),
    s AS (SELECT query_id, avg(distance) AS m FROM n GROUP BY query_id),
    k AS (SELECT query_id FROM s ORDER BY m {pick}, md5('1:' || query_id) LIMIT (SELECT count(*) FROM p WHERE y = 1))
    SELECT id::VARCHAR AS id, y FROM p WHERE y = 1 OR id::VARCHAR IN (SELECT query_id FROM k)"""


def _near_miss(version):
    def run(spark, d):
        return sampling.near_miss(_points(spark, d), "y", "id", version=version).select("id", "y")

    return run


for _v in (1, 2, 3):
    query(f"near_miss_{_v}", _near_miss_sql(_v))(_near_miss(_v))


def _enn_sql(table: str) -> str:
    return f"""nn AS ({knn_sql(table, table, 3)}), bad AS (SELECT DISTINCT query_id FROM nn JOIN {table} a ON a.id::VARCHAR = query_id
      JOIN {table} b ON b.id::VARCHAR = neighbor_id WHERE a.y <> b.y)"""


@query("edited_neighbors", f"{P}, {_enn_sql('p')} SELECT id::VARCHAR AS id, y FROM p WHERE id::VARCHAR NOT IN (SELECT query_id FROM bad)")
def edited_neighbors(spark, d):
    return sampling.edited_neighbors(_points(spark, d), "y", "id").select("id", "y")


def _tomek_sql(table: str) -> str:
    return f"""one AS MATERIALIZED ({knn_sql(table, table, 1)}), links AS (SELECT x.query_id AS a, x.neighbor_id AS b FROM one x JOIN one z
      ON x.query_id = z.neighbor_id AND x.neighbor_id = z.query_id JOIN {table} p1 ON p1.id::VARCHAR = x.query_id
      JOIN {table} p2 ON p2.id::VARCHAR = x.neighbor_id WHERE x.query_id < x.neighbor_id AND p1.y <> p2.y)"""


@query("tomek_links", f"{P}, {_tomek_sql('p')} SELECT a, b FROM links")
def tomek_links(spark, d):
    return sampling.tomek_links(_points(spark, d), "y", "id")


@query("drop_tomek", f"{P}, {_tomek_sql('p')} SELECT id::VARCHAR AS id, y FROM p WHERE id::VARCHAR NOT IN (SELECT a FROM links UNION ALL SELECT b FROM links)")
def drop_tomek(spark, d):
    return sampling.drop_tomek(_points(spark, d), "y", "id").select("id", "y")


@query("smote_enn", SMOTE + f", {_enn_sql('allp')} SELECT id, y FROM allp WHERE id NOT IN (SELECT query_id FROM bad)")
def smote_enn(spark, d):
    return sampling.smote_enn(_points(spark, d), "y", "id").select("id", "y")


@query("smote_tomek", SMOTE + f", {_tomek_sql('allp')} SELECT id, y FROM allp WHERE id NOT IN (SELECT a FROM links UNION ALL SELECT b FROM links)")
def smote_tomek(spark, d):
    return sampling.smote_tomek(_points(spark, d), "y", "id").select("id", "y")


@query("sampler_by_name", f"{P} SELECT y, count(*) AS n FROM p GROUP BY y")
def sampler_by_name(spark, d):
    sampler = sampling.sampler_by_name("Passthrough")
    return sampler(_points(spark, d), "y", "id").groupBy("y").agg(F.count(F.lit(1)).alias("n"))
