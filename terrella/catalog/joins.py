"""Queries for joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrella.catalog.files import merge_tables
from terrella.catalog.functions import haversine_sql
from terrella.catalog.registry import query
from terrella.operators import joins as ops
from terrella.operators import matrix
from terrella.operators.knn import k_nearest, k_nearest_in_passes
from terrella.operators.metrics import class_means
from terrella.plans.rainfall import CITIES, RADIUS_KM
from terrella.plans.views import with_views

_CITIES_SQL = ", ".join(f"('{c}', {lon:.4f}e0, {lat:.4f}e0)" for c, (lon, lat) in CITIES.items())


@query(
    "join_inner_broadcast",
    with_views("obs", "stations")
    + """ SELECT station_id, obs_ts, type, val, latitude, longitude FROM obs JOIN stations USING (station_id)""",
)
def join_inner_broadcast(t):
    return ops.lookup_join(t.obs, t.stations, ["station_id"])


@query(
    "join_shuffle_merge",
    """SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_extendedprice, o_custkey, o_totalprice
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_shuffle_merge(t):
    items = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey", "l_extendedprice")
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey", "o_totalprice")
    return ops.shuffle_join(items, orders, ["orderkey"])


@query(
    "join_shuffle_fraction",
    """SELECT o_orderkey AS key, o_orderkey * 2 AS left_value, o_orderkey * 3 AS right_value
       FROM orders WHERE o_orderkey * 7919 % 10 < 3""",
)
def join_shuffle_fraction(t):
    left, right = merge_tables(t)
    return ops.shuffle_join(left, right, ["key"])


@query(
    "join_within_radius",
    with_views("stations")
    + f""", cities(center, lon, lat) AS (VALUES {_CITIES_SQL}),
      near AS (SELECT station_id, center, {haversine_sql("longitude", "latitude", "lon", "lat")} AS km
               FROM stations, cities)
      SELECT station_id, center, round(km, 6) AS distance_km FROM near WHERE km <= 25""",
)
def join_within_radius(t):
    near = ops.near_centers(t.stations, CITIES, RADIUS_KM)
    return near.select("station_id", "center", F.round("distance_km", 6).alias("distance_km"))


@query(
    "join_fixed_radius",
    with_views("stations")
    + f""" SELECT id1, id2, round(km, 6) AS distance_km FROM (
        SELECT a.station_id AS id1, b.station_id AS id2,
               {haversine_sql("a.longitude", "a.latitude", "b.longitude", "b.latitude")} AS km
        FROM stations a JOIN stations b ON a.station_id < b.station_id) p WHERE km <= 10""",
)
def join_fixed_radius(t):
    """Pairs of stations within 10 km."""
    places = t.stations.select(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), F.col("station_id").alias("id"))
    pairs = ops.fixed_radius_pairs(places, 10.0)
    return pairs.select("id1", "id2", F.round("distance_km", 6).alias("distance_km"))


@query(
    "knn_exact",
    """WITH m AS (SELECT label, pos, avg(x) AS x FROM (
           SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) u
         GROUP BY 1, 2),
       q AS (SELECT label AS query_id, list(x ORDER BY pos) AS v FROM m GROUP BY 1),
       d AS (SELECT query_id, vec_id AS index_id, list_distance(embedding::DOUBLE[], v) AS distance
             FROM embeddings, q),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, index_id) AS rank FROM d)
       SELECT query_id, CAST(rank AS INT) AS rank, index_id, round(distance, 6) AS distance FROM r WHERE rank <= 6""",
)
def knn_exact(t):
    """The six embeddings nearest to the mean vector of each label."""
    means = class_means(t.embeddings, "embedding", "label", 64)
    asked = means.select(F.col("label").alias("vec_id"), F.col("center").alias("embedding"))
    found = k_nearest(t.embeddings, asked, k=6)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "knn_all",
    """WITH d AS (SELECT q.vec_id AS query_id, i.vec_id AS index_id, list_distance(i.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS distance
         FROM embeddings i, embeddings q),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, index_id) AS rank FROM d)
       SELECT query_id, CAST(rank AS INT) AS rank, index_id, round(distance, 6) AS distance FROM r WHERE rank <= 6""",
)
def knn_all(t):
    """The six nearest of every embedding, in passes of 128 KB of queries."""
    found = k_nearest_in_passes(t.embeddings, t.embeddings, k=6, pass_bytes=128 << 10)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "broadcast_scalar",
    """SELECT l_orderkey, l_linenumber, l_quantity, (SELECT max(l_quantity) FROM lineitem) AS max_quantity
       FROM lineitem""",
)
def broadcast_scalar(t):
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return ops.broadcast_scalar(items, t.lineitem.agg(F.max("l_quantity").alias("m")), "max_quantity")


@query(
    "matmul_join_agg",
    """WITH a AS (SELECT l_suppkey AS i, l_partkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
       b AS (SELECT l_partkey AS k, l_linenumber AS j, sum(l_discount) AS v FROM lineitem GROUP BY 1, 2)
       SELECT i, j, round(sum(a.v * b.v), 4) AS v FROM a JOIN b USING (k) GROUP BY 1, 2""",
)
def matmul_join_agg(t):
    a, b = matrices(t)
    return ops.matmul(a, b).withColumn("v", F.round("v", 4))


@query(
    "matmul_blocks",
    """WITH a AS (SELECT l_suppkey AS i, l_partkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
       b AS (SELECT l_partkey AS k, l_linenumber AS j, sum(l_discount) AS v FROM lineitem GROUP BY 1, 2)
       SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(sum(a.v * b.v), 4) AS v FROM a JOIN b USING (k)
       GROUP BY 1, 2 HAVING sum(a.v * b.v) <> 0""",
)
def matmul_blocks(t):
    """The same product by dense tiles."""
    a, b = matrices(t)
    return matrix.matmul_blocks(a, b).withColumn("v", F.round("v", 4))


def matrices(t):
    """Supplier x part quantities, and part x line-number discounts."""
    items = t.lineitem
    a = items.groupBy(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("k")).agg(F.sum("l_quantity").alias("v"))
    b = items.groupBy(F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("j")).agg(F.sum("l_discount").alias("v"))
    return a, b
