"""Points, great-circle distances and grid snapping. Angles are in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def point(lon: Column, lat: Column) -> Column:
    """A point as a struct, longitude first."""
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def grid_floor(value: Column, step: float = 0.01) -> Column:
    """Lower edge of the grid cell; negative values move down as well."""
    return F.floor(value.cast("double") / step) * F.lit(step)
