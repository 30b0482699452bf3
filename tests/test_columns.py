import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.operators import columns
from terrella.plans import trips

TRIP_SCHEMA = """ Tpep_Pickup_Datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, passenger_count LONG,
 trip_distance DOUBLE, pickup_longitude DOUBLE, pickup_latitude DOUBLE, RatecodeID LONG,
 dropoff_longitude DOUBLE, dropoff_latitude DOUBLE, fare_amount DOUBLE, note STRING"""

NOON, LATER = dt.datetime(2025, 7, 6, 12), dt.datetime(2025, 7, 6, 12, 30)


def trip(**changes):
    row = dict(
        pickup=NOON, dropoff=LATER, passengers=1, distance=3.0, plon=-73.987, plat=40.75, rate=1,
        dlon=-73.95, dlat=40.78, fare=12.0, note="x",
    )
    return tuple({**row, **changes}.values())


def test_rows_with_missing_values(spark):
    rows = [
        trip(),
        trip(fare=None),
        trip(passengers=None),
        trip(rate=None),
        trip(distance=float("nan")),
        trip(dropoff=NOON),
        trip(passengers=1 << 40),
        trip(pickup=None, dropoff=None),
    ]
    raw = spark.createDataFrame(rows, TRIP_SCHEMA)
    raw = raw.toDF(*[f" {c} " for c in raw.columns])
    clean = trips.clean(raw)
    assert tuple(clean.columns) == (
        "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "pickup_longitude",
        "pickup_latitude", "rate_code", "dropoff_longitude", "dropoff_latitude", "fare_amount",
    )
    assert clean.schema["passenger_count"].dataType == T.IntegerType()
    assert clean.schema["fare_amount"].dataType == T.FloatType()
    assert clean.filter("fare_amount = -1 or passenger_count = -1 or trip_distance = -1").count() == 4
    kept = trips.drop_outliers(clean)
    # Only a missing rate code survives; every other hole fails a rule.
    assert sorted(r["rate_code"] for r in kept.collect()) == [-1, 1]
    features = trips.add_features(kept).first()
    assert (features["diff"], features["day_of_week"], features["is_weekend"]) == (1800, 6, 1)
    assert abs(features["pickup_longitude_r"] + 73.99) < 1e-9


def test_sentinel_timestamp(spark):
    holes = spark.createDataFrame([(None,)], "t TIMESTAMP_NTZ")
    assert columns.fill_sentinel(holes).first()["t"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)


def test_downcast_overflow_is_null(spark):
    wide = spark.createDataFrame([(1 << 40, 0.1), (7, 1e300)], "a LONG, b DOUBLE")
    first, second = columns.downcast_numeric(wide).collect()
    assert first["a"] is None and second["a"] == 7 and second["b"] == float("inf")


def test_constant_chain(spark):
    start = columns.with_literals(spark.range(10), a=3.0, b=4.0)
    # With the values 3 and 4: 2 * 3 + (4 + 1) = 11.
    done = columns.elementwise_chain(start, [("a", "2 * a"), ("b", "b + 1"), ("c", "a + b")])
    assert {r["c"] for r in done.collect()} == {11.0}


def test_features_are_in_name_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b INT, y INT, a INT")
    features, label = columns.split_features_label(df, "y")
    assert features.columns == ["a", "b"] and label.columns == ["y"]


def test_drop_and_keep(spark):
    df = spark.createDataFrame([("x", 1, 2.0)], "s STRING, i INT, d DOUBLE")
    assert columns.drop_types(df, T.StringType).columns == ["i", "d"]
    assert columns.keep_columns(df, ["d", "s", "nope"]).columns == ["s", "d"]


def test_cast_bad_text(spark):
    df = spark.createDataFrame([("1.5",), ("bad",)], "v STRING")
    assert [r["v"] for r in columns.cast_columns(df, {"v": "double"}).collect()] == [1.5, None]


def test_previews_and_counts(spark):
    df = spark.range(20)
    assert columns.count_matches(df, {"even": "id % 2 = 0", "none": "id < 0"}).first().asDict() == {"even": 10, "none": 0}
    assert [r["id"] for r in columns.preview_matches(df, "id > 3", [F.desc("id")], 2).collect()] == [19, 18]


def test_array_of_another_length_is_an_error(spark):
    good = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<double>")
    assert [tuple(r) for r in columns.array_to_columns(good, "v", ["x", "y"]).orderBy("id").collect()] == [
        (1, 1.0, 2.0),
        (2, None, None),
    ]
    with pytest.raises(Exception, match="2 elements of v wanted"):
        columns.array_to_columns(spark.createDataFrame([(1, [1.0])], "id int, v array<double>"), "v", ["x", "y"]).collect()
