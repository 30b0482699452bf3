"""Views over the shared tables, as SQL text that Spark and other engines read alike.

``{table}`` stands for a base table. Literals such as ``1e3`` keep arithmetic
in double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrella.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Every 1500 keys fill a square of 1.5 degrees, half of them near either city; the next 1500 go to the next square,
# 80 squares along and 20 up. Once around, places move on by a little, so that they depend on the whole key.
STATIONS = """
SELECT c_custkey AS station_id,
  CASE WHEN c_custkey % 2 = 0 THEN 33.0e0 ELSE 46.9e0 END + (c_custkey * 7919 % 1500) / 1e3
    + 15e-1 * (floor(c_custkey / 12e4) % 20) + floor(c_custkey / 24e5) / 1e5 AS latitude,
  CASE WHEN c_custkey % 2 = 0 THEN -85.1e0 ELSE -123.1e0 END + (c_custkey * 104729 % 1500) / 1e3
    + 15e-1 * (floor(c_custkey / 15e2) % 80) + floor(c_custkey / 24e5) / 1e5 AS longitude
FROM {customer}
"""

OBS = """
SELECT o_custkey AS station_id, o_orderdate AS obs_ts,
  CASE o_orderkey % 4 WHEN 0 THEN 'SNWD' WHEN 1 THEN 'TMAX' WHEN 2 THEN 'TMIN' ELSE 'PRCP' END AS type,
  CAST(floor(o_totalprice) AS BIGINT) % 500 AS val
FROM {orders}
"""

TRIPS = """
SELECT l_orderkey, l_linenumber,
  o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
  CAST(l_linenumber AS INT) AS passenger_count,
  CASE WHEN l_partkey % 97 = 0 THEN 0e0 WHEN l_partkey % 89 = 0 THEN 600e0 ELSE l_quantity * 15e-1 END AS trip_distance,
  CASE WHEN l_orderkey % 50 = 0 THEN -70e0 ELSE -74.05e0 + (o_custkey * 7919 % 200) / 1e3 END AS pickup_longitude,
  CASE WHEN l_orderkey % 53 = 0 THEN 0e0 ELSE 40.6e0 + (o_custkey * 104729 % 300) / 1e3 END AS pickup_latitude,
  CASE WHEN l_orderkey % 59 = 0 THEN 0e0 ELSE -74.05e0 + (l_suppkey * 7919 % 200) / 1e3 END AS dropoff_longitude,
  CASE WHEN l_orderkey % 61 = 0 THEN 43e0 ELSE 40.6e0 + (l_suppkey * 104729 % 300) / 1e3 END AS dropoff_latitude,
  CAST(1 + l_partkey % 6 AS INT) AS rate_code,
  CASE WHEN l_partkey % 83 = 0 THEN 5e-1 ELSE l_extendedprice / 2e2 END AS fare_amount
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

SCORED = """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y,
  (round(value, 0) - 60e0) / 4e1 AS margin,
  1e0 / (1e0 + exp(-((round(value, 0) - 60e0) / 4e1))) AS score
FROM {events}
"""

# One cell per order: a grid 50 cells wide that gets longer with the table.
CELLS = """
SELECT i, j, v, (i = 0 OR j = 0 OR j = 49 OR i = (
    SELECT CAST(floor(max(o_orderkey) / 5e1) AS BIGINT) FROM {orders})) AS is_border
FROM (SELECT CAST(floor(o_orderkey / 5e1) AS BIGINT) AS i, o_orderkey % 50 AS j,
        CAST(o_orderkey * 31 % 100 AS DOUBLE) AS v FROM {orders}) AS placed
"""

VIEWS = {"stations": STATIONS, "obs": OBS, "trips": TRIPS, "scored": SCORED, "cells": CELLS}


class Tables:
    """Base tables and views of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        if name in VIEWS:
            text = VIEWS[name]
            bases = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
            return self.spark.sql(text, **bases)
        raise AttributeError(name)


def view_sql(name: str) -> str:
    """A view as plain SQL over the base table names."""
    return VIEWS[name].format(**{t: t for t in TABLES}).strip()


def with_views(*names: str) -> str:
    """A WITH clause that defines the named views."""
    return "WITH " + ",\n".join(f"{n} AS ({view_sql(n)})" for n in names)
