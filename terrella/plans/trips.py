"""Cleaning trip records and building features for fare prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.functions.geo import grid_floor, haversine_km
from terrella.functions.temporal import date_parts, duration_seconds, is_weekend, weekday
from terrella.operators.columns import (
    downcast_numeric,
    drop_types,
    fill_sentinel,
    filter_all,
    keep_columns,
    normalize_names,
)

# Common names of columns that changed between file versions,
# the columns kept, and the outlier rules.
TRIP_ALIASES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "ratecodeid": "rate_code",
}
TRIP_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "rate_code",
    "dropoff_longitude",
    "dropoff_latitude",
    "fare_amount",
)
TRIP_RULES = (
    "fare_amount > 1 and fare_amount < 500",
    "passenger_count > 0 and passenger_count < 6",
    "pickup_longitude > -75 and pickup_longitude < -73",
    "dropoff_longitude > -75 and dropoff_longitude < -73",
    "pickup_latitude > 40 and pickup_latitude < 42",
    "dropoff_latitude > 40 and dropoff_latitude < 42",
    "trip_distance > 0 and trip_distance < 500",
    "not (trip_distance > 50 and fare_amount < 50)",
    "not (trip_distance < 10 and fare_amount > 300)",
    "not dropoff_datetime <= pickup_datetime",
)
COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def clean(trips: DataFrame) -> DataFrame:
    """Common names, kept columns, 32-bit numbers, sentinels for missing values."""
    kept = keep_columns(normalize_names(trips, TRIP_ALIASES), TRIP_COLUMNS)
    return fill_sentinel(downcast_numeric(drop_types(kept, T.StringType)))


def drop_outliers(trips: DataFrame) -> DataFrame:
    return filter_all(trips, TRIP_RULES)


def add_features(trips: DataFrame) -> DataFrame:
    """Date parts, duration, snapped coordinates and distance, in place of the timestamps."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    features = {
        **date_parts(pickup),
        "day_of_week": weekday(pickup),
        "is_weekend": is_weekend(pickup),
        "diff": duration_seconds(pickup, dropoff),
        **{f"{c}_r": grid_floor(F.col(c)) for c in COORDINATES},
        "h_distance": haversine_km(
            *[F.col(c).cast("double") for c in (
                "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"
            )]
        ),
    }
    return trips.withColumns(features).drop("pickup_datetime", "dropoff_datetime")


def trip_features(trips: DataFrame) -> DataFrame:
    """The whole chain; one narrow stage without a shuffle."""
    return add_features(drop_outliers(clean(trips)))
