"""Yearly rain per city, from station positions and daily observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.functions.temporal import date_parts
from terrella.operators.aggregates import group_sum, normalized_group_sum
from terrella.operators.columns import tenths_mm_to_inches
from terrella.operators.joins import lookup_join, near_centers

# City centers as (longitude, latitude) and the radius in km.
CITIES = {"Atlanta": (-84.3880, 33.7490), "Seattle": (-122.3517, 47.6219)}
RADIUS_KM = 25.0


def station_year_totals(obs: DataFrame) -> DataFrame:
    """Rain in inches per station and year."""
    rain = obs.filter(F.col("type") == "PRCP").select(
        "station_id",
        date_parts(F.col("obs_ts"))["year"].alias("year"),
        tenths_mm_to_inches(F.col("val")).alias("val"),
    )
    return group_sum(rain, ["station_id", "year"], "val", "rain")


def city_stations(stations: DataFrame) -> DataFrame:
    """Stations within the radius of each city: (city, station_id)."""
    return near_centers(stations, CITIES, RADIUS_KM).select(
        F.col("center").alias("city"), "station_id"
    )


def rainfall_by_city_year(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Rain per city and year, divided by the number of stations of the city.

    Observations shrink to one row per station and year before they meet the
    stations. All stations in the radius count, also those without rain.
    """
    near = city_stations(stations)
    yearly = lookup_join(station_year_totals(obs), near, ["station_id"])
    return normalized_group_sum(yearly, ["city", "year"], "rain", near, ["city"], "rain")
