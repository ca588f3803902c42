"""Queries for drift injection, drift tests and the monitor."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskloom.operators import drift
from riskloom.operators.drift import DIRECTIONS, column_direction
from riskloom.plans import data
from riskloom.plans.catalog_profile import rounded
from riskloom.plans.registry import query
from riskloom.runtime import materialize, scratch_path
from riskloom.sources.tables import newest, read_drift_json

E = f"WITH e AS ({data.DRIFT_SQL})"


def draw_sql(text: str, start: int = 1) -> str:
    """Uniform draw from eight hex digits of a digest."""
    return f"(('0x' || substr(md5({text}), {start}, 8))::BIGINT / 4294967296.0e0)"


def normal_sql(text: str) -> str:
    return f"(sqrt(-2.0e0 * ln(1.0e0 - {draw_sql(text, 1)})) * cos({2 * math.pi!r} * {draw_sql(text, 9)}))"


def _shift_sql(c: str, seed: int, intensity: float) -> str:
    noise = f"{normal_sql(f"'{seed}:{c}:' || event_id")} * ({intensity}e0 * (SELECT stddev_samp({c}) FROM e))"
    way = column_direction(seed, c)
    signed = noise if way == DIRECTIONS[2] else f"abs({noise})" if way == DIRECTIONS[0] else f"-abs({noise})"
    return f"round({c} + {signed}, 6)"


@query(
    "inject_numeric_drift",
    f"{E} SELECT event_id, {_shift_sql('value', 42, 0.25)} AS value, {_shift_sql('user_id', 42, 0.25)} AS user_id, "
    "quarter, late FROM e",
)
def inject_numeric_drift(spark, d):
    df = data._frame(spark, d, "events", data.DRIFT).drop("event_type")
    out, _ = drift.inject_drift(df, "event_id", 0.25, 42, target="late", exclude=["quarter", "parity"])
    return rounded(out.drop("parity"), ["value", "user_id"], 6)


@query(
    "inject_category_drift",
    f"""{E}, v AS (SELECT DISTINCT event_type AS name FROM e),
    w AS (SELECT name, -ln(1.0e0 - {draw_sql("'42:share:event_type:' || name")}) AS w FROM v),
    s AS (SELECT name, sum(w) OVER (ORDER BY name ROWS UNBOUNDED PRECEDING) / sum(w) OVER () AS hi, w / sum(w) OVER () AS share FROM w),
    r AS (SELECT name, hi, coalesce(lag(hi) OVER (ORDER BY hi), 0) AS lo, row_number() OVER (ORDER BY hi DESC) AS last FROM s),
    p AS (SELECT event_id, {draw_sql("'42:pick:event_type:' || event_id")} AS u FROM e)
    SELECT event_id, name AS event_type FROM p JOIN r ON u >= lo AND (u < hi OR last = 1)""",
)
def inject_category_drift(spark, d):
    df = data._frame(spark, d, "events", data.DRIFT).select("event_id", "event_type")
    return drift.inject_drift(df, "event_id")[0]


@query("drift_change_log", f"""{E} SELECT 'value' AS "column", 'numérico' AS kind, '{column_direction(42, "value")}' AS direction FROM e HAVING stddev_samp(value) > 0
UNION ALL SELECT 'user_id', 'numérico', '{column_direction(42, "user_id")}' FROM e HAVING stddev_samp(user_id) > 0
UNION ALL SELECT 'event_type', 'categórico', 'reajuste distribución' FROM e HAVING count(DISTINCT event_type) > 1""")
def drift_change_log(spark, d):
    df = data._frame(spark, d, "events", data.DRIFT)
    return drift.inject_drift(df, "event_id", 0.25, 42, target="late", exclude=["quarter", "parity"])[1]


def _ks_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", max(abs(cr / (SELECT count(*) FROM e WHERE late = 0)::DOUBLE - cc / (SELECT count(*) FROM e WHERE late = 1)::DOUBLE)) AS s
    FROM (SELECT sum(r) OVER (ORDER BY v) AS cr, sum(k) OVER (ORDER BY v) AS cc
          FROM (SELECT {c} AS v, sum(1 - late) AS r, sum(late) AS k FROM e GROUP BY {c}))"""


def _chi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", sum(pow(k - r * tc / tr, 2) / (r * tc / tr)) AS s
    FROM (SELECT {c}, sum(1 - late)::DOUBLE AS r, sum(late)::DOUBLE AS k FROM e GROUP BY {c}),
         (SELECT sum(1 - late)::DOUBLE AS tr, sum(late)::DOUBLE AS tc FROM e)"""


def _z_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", (a / tr - b / tc) / sqrt(((a + b) / (tr + tc)) * (1 - (a + b) / (tr + tc)) * (1 / tr + 1 / tc)) AS s
    FROM (SELECT sum(CASE WHEN late = 0 AND {c} = 0 THEN 1 END)::DOUBLE AS a, sum(CASE WHEN late = 1 AND {c} = 0 THEN 1 END)::DOUBLE AS b,
                 sum(1 - late)::DOUBLE AS tr, sum(late)::DOUBLE AS tc FROM e)"""


STATS = f"""{E}, st AS ({_ks_sql('value')} UNION ALL {_ks_sql('user_id')} UNION ALL {_chi_sql('event_type')}
UNION ALL {_chi_sql('quarter')} UNION ALL {_z_sql('parity')})"""


@query(
    "drift_statistics",
    STATS + """ SELECT "column", CASE WHEN "column" = 'event_type' THEN 'cat' ELSE 'num' END AS column_type,
    CASE "column" WHEN 'parity' THEN 'Z-test p_value' WHEN 'value' THEN 'K-S p_value' WHEN 'user_id' THEN 'K-S p_value' ELSE 'chi-square p_value' END AS stattest,
    round(s, 8) AS statistic FROM st""",
)
def drift_statistics(spark, d):
    ref, cur = data.drift_sides(spark, d)
    stats, _ = drift.drift_statistics(ref, cur)
    return rounded(stats.select("column", "column_type", "stattest", "statistic"), ["statistic"], 8)


@query("ks_distance", f"{E}, st AS ({_ks_sql('value')}) SELECT \"column\", round(s, 8) AS statistic FROM st")
def ks_distance(spark, d):
    ref, cur = data.drift_sides(spark, d)
    return rounded(drift.drift_statistics(ref, cur, columns=["value"])[0].select("column", "statistic"), ["statistic"], 8)


@query("chi_square_distance", f"{E}, st AS ({_chi_sql('event_type')}) SELECT \"column\", round(s, 8) AS statistic FROM st")
def chi_square_distance(spark, d):
    ref, cur = data.drift_sides(spark, d)
    return rounded(drift.drift_statistics(ref, cur, columns=["event_type"])[0].select("column", "statistic"), ["statistic"], 8)


@query("proportion_z", f"{E}, st AS ({_z_sql('parity')}) SELECT \"column\", round(s, 8) AS statistic FROM st")
def proportion_z(spark, d):
    ref, cur = data.drift_sides(spark, d)
    return rounded(drift.drift_statistics(ref, cur, columns=["parity"])[0].select("column", "statistic"), ["statistic"], 8)


@query("drift_report")
def drift_report(spark, d):
    ref, cur = data.drift_sides(spark, d)
    return drift.drift_report(ref, cur)


def _density_sql(side: str, late: int) -> str:
    return f"""SELECT '{side}' AS side, bin, round(lo + bin * (hi - lo) / 10, 6) AS lower, round(n / (t * (hi - lo) / 10), 8) AS density
    FROM (SELECT least(CAST(floor((value - lo) * 10 / (hi - lo)) AS INT), 9) AS bin, count(*)::DOUBLE AS n, any_value(lo) AS lo, any_value(hi) AS hi, any_value(t) AS t
          FROM e, (SELECT min(value) AS lo, max(value) AS hi, count(*) AS t FROM e WHERE late = {late}) WHERE late = {late} GROUP BY 1)"""


@query("side_densities", f"{E} {_density_sql('reference', 0)} UNION ALL {_density_sql('current', 1)}")
def side_densities(spark, d):
    ref, cur = data.drift_sides(spark, d)
    _, counts = drift.drift_statistics(ref, cur, columns=["value"])
    shapes = drift.side_densities(counts)
    parts = [
        shapes.select(F.lit(s).alias("side"), F.posexplode(f"{s}.y").alias("bin", "density"), F.col(f"{s}.x").alias("x"))
        for s in ("reference", "current")
    ]
    both = parts[0].unionByName(parts[1]).where("density > 0")
    return both.select("side", "bin", F.round(F.get("x", F.col("bin")), 6).alias("lower"), F.round("density", 8).alias("density"))


@query(
    "category_counts",
    f"{E} SELECT 'event_type' AS \"column\", event_type AS value, sum(1 - late)::BIGINT AS n_ref, sum(late)::BIGINT AS n_cur FROM e GROUP BY event_type",
)
def category_counts(spark, d):
    ref, cur = data.drift_sides(spark, d)
    return drift.category_counts(drift.drift_statistics(ref, cur, columns=["event_type"])[1])


@query(
    "drift_shapes",
    f"""{E} SELECT 'value' AS "column", side, NULL::VARCHAR AS label, lower AS x, density AS y
    FROM ({_density_sql('reference', 0)} UNION ALL {_density_sql('current', 1)})
    UNION ALL SELECT 'event_type', 'reference', event_type, NULL, sum(1 - late)::DOUBLE FROM e GROUP BY event_type
    UNION ALL SELECT 'event_type', 'current', event_type, NULL, sum(late)::DOUBLE FROM e GROUP BY event_type""",
)
def drift_shapes(spark, d):
    ref, cur = data.drift_sides(spark, d)
    _, shapes = drift.drift_report_and_shapes(ref, cur, columns=["value", "event_type"])
    shapes = shapes.where("label IS NOT NULL OR y > 0")
    return shapes.select("column", "side", "label", F.round("x", 6).alias("x"), F.round("y", 8).alias("y"))


# A report per user built from plain arithmetic, so that roll-ups have an exact SQL twin.
VERDICTS = """SELECT CAST(user_id AS STRING) AS "column", avg(value) / 500e0 AS drift_score, avg(value) < 40e0 AS drift_detected FROM events GROUP BY user_id"""


def _verdicts(spark, d):
    per_user = data.read(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("column"))
    mean = F.avg("value")
    return per_user.agg((mean / 500.0).alias("drift_score"), (mean < 40.0).alias("drift_detected"))


ROLL = f"""WITH v AS ({VERDICTS}), r AS (SELECT count(*) AS total_columns, count(CASE WHEN drift_detected THEN 1 END) AS drifted_columns FROM v),
x AS (SELECT *, drifted_columns / total_columns::DOUBLE AS drift_share FROM r)"""


def _level(part: int) -> str:
    t = (
        ("🟢 Sin drift detectable", "🟡 Drift leve", "🟠 Drift moderado", "🔴 Drift severo"),
        (
            "No se requiere acción.",
            "Monitorear próximas ejecuciones.",
            "Revisar pipeline de features o data sources recientes.",
            "⚙️ Reentrenar modelo.",
        ),
    )[part]
    return f"CASE WHEN drift_share = 0 THEN '{t[0]}' WHEN drift_share < 0.2 THEN '{t[1]}' WHEN drift_share < 0.5 THEN '{t[2]}' ELSE '{t[3]}' END"


@query("drift_roll_up", ROLL + " SELECT total_columns, drifted_columns, round(drift_share, 8) AS drift_share, drift_share >= 0.5 AS dataset_drift FROM x")
def drift_roll_up(spark, d):
    return rounded(drift.dataset_drift(_verdicts(spark, d)), ["drift_share"], 8)


@query(
    "drift_severity",
    ROLL.replace("FROM events GROUP BY user_id", "FROM events GROUP BY user_id")
    + f" SELECT drifted_columns, {_level(0)} AS level, {_level(1)} AS action FROM x",
)
def drift_severity(spark, d):
    level, action = drift.severity(F.col("drift_share"))
    return drift.roll_up(_verdicts(spark, d)).select("drifted_columns", level.alias("level"), action.alias("action"))


@query(
    "most_drifted",
    f"WITH v AS ({VERDICTS}) SELECT \"column\", round(drift_score, 8) AS drift_score FROM v WHERE drift_detected ORDER BY v.drift_score, \"column\" LIMIT 8",
)
def most_drifted(spark, d):
    return rounded(drift.most_drifted(_verdicts(spark, d), 8).select("column", "drift_score"), ["drift_score"], 8)


@query(
    "drift_monitor_record",
    ROLL + f""", t AS (SELECT string_agg("column", ', ' ORDER BY drift_score, "column") AS names FROM
    (SELECT * FROM v WHERE drift_detected ORDER BY drift_score, "column" LIMIT 5))
    SELECT total_columns, drifted_columns, round(drift_share, 8) AS drift_share, {_level(0)} AS level, {_level(1)} AS action,
           'users' AS source, coalesce(names, 'Ninguna') AS top_columns_drift FROM x, t""",
)
def drift_monitor_record(spark, d):
    return rounded(drift.monitor_record(_verdicts(spark, d), "users").drop("timestamp"), ["drift_share"], 8)


@query("drift_monitor_log")
def drift_monitor_log(spark, d):
    ref, cur = data.drift_sides(spark, d)
    log = scratch_path(spark, "driftlog")
    drift.monitor(ref, cur, log, "halves")
    drift.monitor(ref, ref, log, "same")
    return newest(spark.read.parquet(log), "timestamp", 2).drop("timestamp")


@query(
    "drift_json_read",
    f"WITH v AS ({VERDICTS}) SELECT \"column\", 'num' AS column_type, 'K-S p_value' AS stattest, 0.05 AS threshold, "
    "round(drift_score, 8) AS drift_score, drift_detected FROM v",
)
def drift_json_read(spark, d):
    entry = F.struct(
        F.lit("num").alias("column_type"),
        F.lit("K-S p_value").alias("stattest_name"),
        F.lit(0.05).alias("stattest_threshold"),
        F.col("drift_score"),
        F.col("drift_detected"),
    )
    verdicts = materialize(_verdicts(spark, d), "verdicts")
    # one summary document per leading digit of the column name
    docs = verdicts.groupBy(F.substring("column", 1, 1).alias("part")).agg(
        F.map_from_entries(F.collect_list(F.struct("column", entry))).alias("m")
    )
    table = F.struct(F.lit("DataDriftTable").alias("metric"), F.struct(F.col("m").alias("drift_by_columns")).alias("result"))
    head = F.struct(F.lit("DatasetDriftMetric").alias("metric"), F.struct(F.lit(None).cast(docs.schema["m"].dataType).alias("drift_by_columns")).alias("result"))
    path = scratch_path(spark, "driftjson")
    docs.select(F.array(head, table).alias("metrics")).write.json(path)
    return rounded(read_drift_json(spark, path).drop("source"), ["drift_score"], 8)
