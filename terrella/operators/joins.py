"""Equi-joins, radius joins, broadcast of one value, and the matrix product."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.functions.geo import EARTH_RADIUS_KM, haversine_km
from terrella.operators.skew import salted_join

#: A side may be broadcast when its rows take at most this many bytes.
BROADCAST_BYTES = 64 << 20
_FIELD_BYTES = 16


def _extra_bytes(field: T.StructField) -> Column | None:
    """Bytes of one value beyond the fixed part, for types without a fixed size."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(column)))
    return None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring that the table is small.

    One distributed aggregate adds up the bytes. A larger table is returned
    without a hint, and Spark picks a shuffle join.
    """
    extras = [e for e in map(_extra_bytes, df.schema) if e is not None]
    width = reduce(lambda a, b: a + b, extras, F.lit(_FIELD_BYTES * len(df.columns)))
    measured = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if measured <= max_bytes else df


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner equi-join with a usually small side."""
    return facts.join(broadcast_if_small(lookup, max_bytes), list(on))


def shuffle_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi-join of two large tables.

    The merge hint keeps either side from being broadcast whatever its
    estimated size. Heavy keys are split by adaptive execution at run time.
    """
    return left.join(right.hint("merge"), list(on))


def near_centers(
    points: DataFrame,
    centers: Mapping[str, tuple[float, float]],
    radius_km: float,
    lon: str = "longitude",
    lat: str = "latitude",
) -> DataFrame:
    """Points within a radius of a few named (lon, lat) centers given as literals.

    Adds ``center`` and ``distance_km``; a point near several centers appears
    once for each. A narrow projection: nothing is joined or shuffled.
    """
    candidates = F.array(
        *[
            F.struct(
                F.lit(name).alias("center"),
                haversine_km(F.col(lon), F.col(lat), F.lit(x), F.lit(y)).alias("distance_km"),
            )
            for name, (x, y) in centers.items()
        ]
    )
    hits = F.filter(candidates, lambda c: c["distance_km"] <= radius_km)
    return points.select("*", F.inline(hits))


class _SphereCells:
    """Latitude bands of one radius' height, each cut into equal longitude cells.

    Cells near the poles get wider, and numbering wraps at 180 degrees, so two
    points within the radius are always in touching cells.
    """

    def __init__(self, radius_km: float):
        angle = radius_km / EARTH_RADIUS_KM
        # A hair more than the radius, so rounding cannot push a pair further apart.
        height = math.degrees(angle) * (1 + 1e-9)
        self.band = f"cast(floor((lat + 90) / {height!r}D) as bigint)"
        # Latitude nearest to a pole that a point within the radius of the band can have.
        edge = f"greatest(abs((_band - 1) * {height!r}D - 90), abs((_band + 2) * {height!r}D - 90))"
        ratio = f"{math.sin(min(angle, math.pi / 2))!r}D / cos(radians({edge}))"
        close = str(angle < math.pi / 2).lower()
        # Largest longitude gap between a point of the band and a near one.
        self.reach = (
            f"case when {close} and {edge} < 90 and {ratio} < 1 "
            f"then degrees(asin({ratio})) * (1 + 1e-9D) else 180D end"
        )
        self.count = "greatest(1L, cast(floor(360 / _reach) as bigint))"

    def _sized(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_reach", F.expr(self.reach)).withColumn("_count", F.expr(self.count))

    def home(self, df: DataFrame) -> DataFrame:
        """Add the one cell each point belongs to."""
        sized = self._sized(df.withColumn("_band", F.expr(self.band)))
        cell = F.expr("pmod(cast(floor((lon + 180) / (360 / _count)) as bigint), _count)")
        return sized.withColumn("_cell", cell).drop("_reach", "_count")

    def touching(self, df: DataFrame) -> DataFrame:
        """One row for each cell that may hold a point within the radius."""
        near = F.expr(f"explode(sequence({self.band} - 1, {self.band} + 1))")
        sized = self._sized(df.withColumn("_band", near))
        sized = sized.withColumns(
            {
                "_first": F.expr("cast(floor((lon + 180 - _reach) / (360 / _count)) as bigint)"),
                "_last": F.expr("cast(floor((lon + 180 + _reach) / (360 / _count)) as bigint)"),
            }
        )
        run = F.expr("explode(sequence(_first, least(_last, _first + _count - 1)))")
        return (
            sized.withColumn("_at", run)
            .withColumn("_cell", F.expr("pmod(_at, _count)"))
            .drop("_reach", "_count", "_first", "_last", "_at")
        )


def within_radius(
    left: DataFrame,
    right: DataFrame,
    radius_km: float,
    keep: Column | None = None,
    id_column: str = "id",
    task_rows: int = 20_000,
) -> DataFrame:
    """Pairs of points at most ``radius_km`` apart, from two tables of any size.

    Both tables have ``id_column``, ``lon`` and ``lat``. Each right point is
    copied into the cells it can reach, left points stay in their own cell, and
    the tables meet in an equi-join on the cell. Crowded cells are salted.
    ``keep`` is a further condition on ``id1`` and ``id2``.
    """
    cells = _SphereCells(radius_km)
    one = cells.home(left.select(F.col(id_column).alias("id1"), "lon", "lat"))
    two = cells.touching(right.select(F.col(id_column).alias("id2"), "lon", "lat"))
    pairs = salted_join(
        one.withColumnsRenamed({"lon": "_lon1", "lat": "_lat1"}),
        two.withColumnsRenamed({"lon": "_lon2", "lat": "_lat2"}),
        ["_band", "_cell"],
        ["id1"],
        task_rows,
    )
    if keep is not None:
        pairs = pairs.filter(keep)
    distance = haversine_km(F.col("_lon1"), F.col("_lat1"), F.col("_lon2"), F.col("_lat2"))
    return (
        pairs.withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= radius_km)
        .select("id1", "id2", "distance_km")
    )


def fixed_radius_pairs(
    points: DataFrame, radius_km: float, id_column: str = "id", task_rows: int = 20_000
) -> DataFrame:
    """Each unordered pair of points at most ``radius_km`` apart, once, smaller id first."""
    return within_radius(
        points, points, radius_km, F.col("id1") < F.col("id2"), id_column, task_rows
    )


def broadcast_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Give every row the single value of a one-row, one-column table."""
    return df.withColumn(name, one_row.scalar())


def matmul(a: DataFrame, b: DataFrame, task_rows: int = 100_000) -> DataFrame:
    """Product of two sparse matrices, ``a(i, k, v)`` and ``b(k, j, v)``, as (i, j, v).

    Products are summed on the map side before the shuffle on (i, j); a column
    of ``a`` with very many entries is salted by its row.
    """
    left = a.select("i", "k", F.col("v").alias("_a"))
    right = b.select("k", "j", F.col("v").alias("_b"))
    joined = salted_join(left, right, ["k"], ["i"], task_rows)
    return joined.groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))
