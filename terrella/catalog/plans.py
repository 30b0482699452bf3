"""Whole analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrella.catalog.functions import haversine_sql
from terrella.catalog.learning import boosted_table
from terrella.catalog.registry import query
from terrella.operators.ordering import ranked_sort
from terrella.plans import classifier, rainfall, trips
from terrella.plans.views import with_views

_CITIES_SQL = ", ".join(f"('{c}', {lon:.4f}e0, {lat:.4f}e0)" for c, (lon, lat) in rainfall.CITIES.items())


@query(
    "rainfall_by_city_year",
    with_views("obs", "stations")
    + f""", cities(city, lon, lat) AS (VALUES {_CITIES_SQL}),
      near AS (SELECT city, station_id FROM stations, cities
        WHERE {haversine_sql("longitude", "latitude", "lon", "lat")} <= 25),
      total AS (SELECT city, CAST(year(obs_ts) AS INT) AS year, sum(val * 1 / 10e0 * 0.0393701e0) AS rain
        FROM obs JOIN near USING (station_id) WHERE type = 'PRCP' GROUP BY 1, 2)
      SELECT city, year, round(rain / (SELECT count(*) FROM near n WHERE n.city = total.city), 6) AS rain,
        CAST(row_number() OVER (PARTITION BY city ORDER BY year) AS INT) AS rank FROM total""",
)
def rainfall_by_city_year(t):
    rain = rainfall.rainfall_by_city_year(t.obs, t.stations).withColumn("rain", F.round("rain", 6))
    return ranked_sort(rain, ["city"], ["year"])


_COORDINATES_SQL = ", ".join(
    f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}"
    for c in ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
)


@query(
    "trips_features",
    with_views("trips")
    + f""", c AS (SELECT pickup_datetime, dropoff_datetime, passenger_count, rate_code, {_COORDINATES_SQL},
          CAST(CAST(trip_distance AS FLOAT) AS DOUBLE) AS trip_distance,
          CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) AS fare_amount FROM trips),
      k AS (SELECT * FROM c WHERE {" AND ".join(f"({r})" for r in trips.TRIP_RULES)})
      SELECT passenger_count, rate_code, round(trip_distance, 4) AS trip_distance, round(fare_amount, 3) AS fare_amount,
        round(pickup_longitude, 6) AS pickup_longitude, round(pickup_latitude, 6) AS pickup_latitude,
        round(dropoff_longitude, 6) AS dropoff_longitude, round(dropoff_latitude, 6) AS dropoff_latitude,
        CAST(hour(pickup_datetime) AS INT) AS hour, CAST(year(pickup_datetime) AS INT) AS year,
        CAST(month(pickup_datetime) AS INT) AS month, CAST(day(pickup_datetime) AS INT) AS day,
        CAST(isodow(pickup_datetime) - 1 AS INT) AS day_of_week,
        CASE WHEN isodow(pickup_datetime) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CAST(trunc((epoch_ms(dropoff_datetime) - epoch_ms(pickup_datetime)) / 1e3) AS BIGINT) AS diff,
        round(floor(pickup_latitude / 1e-2) * 1e-2, 6) AS pickup_latitude_r,
        round(floor(pickup_longitude / 1e-2) * 1e-2, 6) AS pickup_longitude_r,
        round(floor(dropoff_latitude / 1e-2) * 1e-2, 6) AS dropoff_latitude_r,
        round(floor(dropoff_longitude / 1e-2) * 1e-2, 6) AS dropoff_longitude_r,
        round({haversine_sql("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")}, 6) AS h_distance
      FROM k""",
)
def trips_features(t):
    features = trips.trip_features(t.trips)
    places = {"trip_distance": 4, "fare_amount": 3}
    shown = [
        F.round(F.col(c).cast("double"), places.get(c, 6)).alias(c) if kind in ("float", "double") else F.col(c)
        for c, kind in features.dtypes
    ]
    return features.select(*shown)


@query("classifier_report")
def classifier_report(t):
    """Quality of boosted trees on the held-out events, as rows (metric, value)."""
    scored = classifier.scored_validation(boosted_table(t), "y", ["event_id"])
    return classifier.quality_table(scored, "y")
