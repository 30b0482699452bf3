"""Queries for grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrella.catalog.registry import query
from terrella.operators import aggregates as ops
from terrella.operators.columns import tenths_mm_to_inches
from terrella.operators.windows import focal_mean
from terrella.plans.rainfall import city_stations, station_year_totals
from terrella.plans.views import with_views

FOCAL_SQL = with_views("cells") + """, swept AS (
  SELECT c.i, c.j, c.is_border,
    CASE WHEN c.is_border THEN c.v ELSE 25e-2 * (n.v + s.v + w.v + e.v) END AS v
  FROM cells c
  LEFT JOIN cells n ON n.i = c.i - 1 AND n.j = c.j LEFT JOIN cells s ON s.i = c.i + 1 AND s.j = c.j
  LEFT JOIN cells w ON w.i = c.i AND w.j = c.j - 1 LEFT JOIN cells e ON e.i = c.i AND e.j = c.j + 1)"""


@query("group_mean", "SELECT event_type, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def group_mean(t):
    return ops.group_mean(t.events, ["event_type"], "value").withColumn("mean", F.round("mean", 6))


@query(
    "group_sum_composite",
    with_views("obs")
    + """ SELECT station_id, CAST(year(obs_ts) AS INT) AS year, round(sum(val * 1 / 10e0 * 0.0393701e0), 6) AS rain
       FROM obs WHERE type = 'PRCP' GROUP BY 1, 2""",
)
def group_sum_composite(t):
    return station_year_totals(t.obs).withColumn("rain", F.round("rain", 6))


@query(
    "group_sum_normalized",
    with_views("obs", "stations")
    + """, near AS (SELECT station_id, CASE WHEN latitude < 40 THEN 'south' ELSE 'north' END AS side FROM stations)
      SELECT side, type, round(sum(val) / (SELECT count(*) FROM near m WHERE m.side = n.side), 6) AS total
      FROM obs JOIN near n USING (station_id) GROUP BY side, type""",
)
def group_sum_normalized(t):
    side = F.when(F.col("latitude") < 40, "south").otherwise("north").alias("side")
    stations = t.stations.select("station_id", side)
    # One row per station and type meets the stations, not every observation.
    sums = ops.group_sum(t.obs, ["station_id", "type"], "val", "val").join(stations, "station_id")
    result = ops.normalized_group_sum(sums, ["side", "type"], "val", stations, ["side"])
    return result.withColumn("total", F.round("total", 6))


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(t):
    return ops.count_rows(t.lineitem)


@query(
    "partial_vs_global_mean",
    """SELECT CAST(event_id % 4 AS INT) AS part, event_type, round(avg(value), 6) AS part_mean,
         round((SELECT avg(value) FROM events g WHERE g.event_type = e.event_type), 6) AS global_mean
       FROM events e GROUP BY 1, 2""",
)
def partial_vs_global_mean(t):
    part = (F.col("event_id") % 4).cast("int")
    both = ops.partial_and_global_mean(t.events, part, "event_type", "value")
    return both.select(
        "part", "event_type", F.round("part_mean", 6).alias("part_mean"), F.round("global_mean", 6).alias("global_mean")
    )


@query(
    "reduce_integral",
    """SELECT round(sum(4e0 / (1e0 + power((o_orderkey + 5e-1) / n, 2)) / n), 9) AS integral
       FROM orders, (SELECT count(*) AS n FROM orders) AS c""",
)
def reduce_integral(t):
    count = t.orders.agg(F.count("*").alias("n")).scalar()
    return ops.midpoint_integral(t.orders, "o_orderkey", count).select(F.round("integral", 9).alias("integral"))


@query(
    "allreduce_sum",
    "SELECT event_id, value, round((SELECT sum(value) FROM events), 4) AS total FROM events",
)
def allreduce_sum(t):
    summed = ops.with_total(t.events.select("event_id", "value"), "value")
    return summed.withColumn("total", F.round("total", 4))


@query(
    "gather_ordered",
    """SELECT conv_id, turn // 4096 AS block, count(*) AS n, string_agg(text, chr(10) ORDER BY turn) AS text
       FROM conversations GROUP BY 1, 2""",
)
def gather_ordered(t):
    gathered = ops.gather_ordered(t.conversations, ["conv_id"], "turn", "text")
    return gathered.select(
        "conv_id", "block", F.size("pieces").cast("long").alias("n"), F.array_join("pieces", "\n").alias("text")
    )


@query(
    "max_abs_change",
    FOCAL_SQL + " SELECT round(max(abs(s.v - c.v)), 6) AS max_change FROM swept s JOIN cells c USING (i, j)",
)
def max_abs_change(t):
    change = ops.max_abs_change(t.cells, focal_mean(t.cells), ["i", "j"], "v")
    return change.withColumn("max_change", F.round("max_change", 6))


@query(
    "diff_count",
    FOCAL_SQL + " SELECT count(*) AS n_diff FROM swept s JOIN cells c USING (i, j) WHERE abs(s.v - c.v) > 1e-6",
)
def diff_count(t):
    return ops.diff_count(t.cells, focal_mean(t.cells), ["i", "j"], "v")


_MEASURES = {"quantity": "l_quantity", "price": "l_extendedprice / 1e3", "discount": "l_discount", "tax": "l_tax"}


@query(
    "covariance_matrix",
    "WITH m AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _MEASURES.items()) + " FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT {a} AS row, {b} AS col, round(covar_samp({x}, {y}), 6) AS cov FROM m"
        for a, x in enumerate(_MEASURES)
        for b, y in enumerate(_MEASURES)
    ),
)
def covariance_matrix(t):
    measures = t.lineitem.select(*[F.expr(e).alias(n) for n, e in _MEASURES.items()])
    return ops.covariance_matrix(measures, list(_MEASURES)).withColumn("cov", F.round("cov", 6))


@query(
    "vector_covariance",
    """WITH e AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
       SELECT a.pos AS row, b.pos AS col, round(covar_samp(a.x, b.x), 9) + 0e0 AS cov
       FROM e AS a JOIN e AS b ON a.vec_id = b.vec_id GROUP BY 1, 2""",
)
def vector_covariance(t):
    return ops.vector_covariance(t.embeddings, "embedding").withColumn("cov", F.round("cov", 9) + 0.0)


@query(
    "column_means",
    "WITH m AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _MEASURES.items()) + " FROM lineitem) "
    + " UNION ALL ".join(f"SELECT '{n}' AS name, round(avg({n}), 8) AS mean FROM m" for n in _MEASURES),
)
def column_means(t):
    measures = t.lineitem.select(*[F.expr(e).alias(n) for n, e in _MEASURES.items()])
    return ops.column_means(measures, list(_MEASURES)).withColumn("mean", F.round("mean", 8))
