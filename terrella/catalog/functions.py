"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrella.catalog.registry import query
from terrella.functions import geo, numeric, temporal, text, vectors
from terrella.plans.rainfall import CITIES
from terrella.plans.views import with_views

HAVERSINE_SQL = (
    "2e0*6371e0*asin(sqrt(power(sin(radians({lat2}-{lat1})/2e0),2) + "
    "cos(radians({lat1}))*cos(radians({lat2}))*power(sin(radians({lon2}-{lon1})/2e0),2)))"
)


def haversine_sql(lon1, lat1, lon2, lat2) -> str:
    return HAVERSINE_SQL.format(lon1=lon1, lat1=lat1, lon2=lon2, lat2=lat2)


@query("fn_slice", "SELECT c_custkey, substring(c_name, 1, 8) AS kind, substring(c_name, 10, 9) AS serial FROM customer")
def fn_slice(t):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey", text.slice_text(name, 0, 8).alias("kind"), text.slice_text(name, 9, 18).alias("serial")
    )


@query("fn_strip_lower", "SELECT p_partkey, lower(p_name) AS name, lower(p_type) AS type FROM part")
def fn_strip_lower(t):
    padded = F.concat(F.lit("\t "), F.upper("p_name"), F.lit(" \r\n"))
    return t.part.select(
        "p_partkey", text.strip_lower(padded).alias("name"), text.strip_lower(F.col("p_type")).alias("type")
    )


@query(
    "fn_parse_date",
    "SELECT o_orderkey, CAST(CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS VARCHAR) AS day FROM orders",
)
def fn_parse_date(t):
    digits = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select("o_orderkey", temporal.parse_date(digits).cast("string").alias("day"))


@query(
    "fn_date_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
       CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour FROM events""",
)
def fn_date_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in temporal.date_parts(F.col("ts")).items()])


@query(
    "fn_weekday_weekend",
    """SELECT event_id, CAST(isodow(ts) - 1 AS INT) AS weekday,
       CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM events""",
)
def fn_weekday_weekend(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", temporal.weekday(ts).alias("weekday"), temporal.is_weekend(ts).alias("is_weekend")
    )


@query(
    "fn_duration_seconds",
    with_views("trips")
    + """ SELECT l_orderkey, l_linenumber,
       CAST(trunc((epoch_ms(dropoff_datetime) - epoch_ms(pickup_datetime)) / 1e3) AS BIGINT) AS seconds FROM trips""",
)
def fn_duration_seconds(t):
    seconds = temporal.duration_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return t.trips.select("l_orderkey", "l_linenumber", seconds.alias("seconds"))


@query(
    "fn_grid_floor",
    with_views("stations")
    + """ SELECT station_id, round(floor(latitude / 1e-2) * 1e-2, 6) AS latitude_r,
       round(floor(longitude / 1e-2) * 1e-2, 6) AS longitude_r FROM stations""",
)
def fn_grid_floor(t):
    return t.stations.select(
        "station_id",
        F.round(geo.grid_floor(F.col("latitude")), 6).alias("latitude_r"),
        F.round(geo.grid_floor(F.col("longitude")), 6).alias("longitude_r"),
    )


@query(
    "fn_haversine",
    with_views("stations")
    + f""" SELECT station_id,
       round({haversine_sql("longitude", "latitude", "-84.3880e0", "33.7490e0")}, 6) AS atlanta_km,
       round({haversine_sql("longitude", "latitude", "-122.3517e0", "47.6219e0")}, 6) AS seattle_km
       FROM stations""",
)
def fn_haversine(t):
    def distance(city):
        lon, lat = CITIES[city]
        return F.round(geo.haversine_km(F.col("longitude"), F.col("latitude"), F.lit(lon), F.lit(lat)), 6)

    return t.stations.select(
        "station_id", distance("Atlanta").alias("atlanta_km"), distance("Seattle").alias("seattle_km")
    )


@query(
    "fn_sigmoid",
    with_views("scored") + " SELECT event_id, round(1e0 / (1e0 + exp(-margin)), 9) AS p FROM scored",
)
def fn_sigmoid(t):
    return t.scored.select("event_id", F.round(numeric.sigmoid(F.col("margin")), 9).alias("p"))


@query(
    "fn_round_half_even",
    with_views("scored")
    + """ SELECT event_id, CAST(round_even(score, 0) AS INT) AS label,
       CAST(round_even(margin, 0) AS INT) AS whole_margin FROM scored""",
)
def fn_round_half_even(t):
    return t.scored.select(
        "event_id",
        numeric.round_half_even(F.col("score")).alias("label"),
        numeric.round_half_even(F.col("margin")).alias("whole_margin"),
    )


@query(
    "fn_argmax",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS top FROM embeddings",
)
def fn_argmax(t):
    return t.embeddings.select("vec_id", vectors.argmax(F.col("embedding")).alias("top"))


@query(
    "fn_softmax",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x,
                  generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
       SELECT vec_id, CAST(pos AS INT) AS pos,
         round(exp(x) / sum(exp(x)) OVER (PARTITION BY vec_id), 9) AS p FROM e""",
)
def fn_softmax(t):
    return t.embeddings.select("vec_id", F.posexplode(vectors.softmax(F.col("embedding"))).alias("pos", "p")).select(
        "vec_id", "pos", F.round("p", 9).alias("p")
    )


@query(
    "fn_l2_distance",
    """SELECT a.vec_id, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS distance
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def fn_l2_distance(t):
    one = t.embeddings.select("vec_id", F.col("embedding").alias("v"))
    following = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("w"))
    distance = F.round(vectors.l2_distance(F.col("v"), F.col("w")), 6)
    return one.join(following, "vec_id").select("vec_id", distance.alias("distance"))


@query(
    "fn_make_point",
    with_views("stations") + " SELECT station_id, longitude AS lon, latitude AS lat FROM stations",
)
def fn_make_point(t):
    point = geo.point(F.col("longitude"), F.col("latitude"))
    return t.stations.select("station_id", point.alias("p")).select("station_id", "p.lon", "p.lat")
