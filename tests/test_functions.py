import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from terrella.functions import geo, numeric, temporal, text, vectors


@pytest.fixture
def one(spark):
    return spark.range(1)


def value(one, column):
    return one.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, clean", [("\t Ab \r\n", "ab"), ("", ""), ("   ", ""), ("a b", "a b"), (" x", "x"), ("x\t", "x")]
)
def test_strip_lower(one, raw, clean):
    assert value(one, text.strip_lower(F.lit(raw))) == clean


def test_slice_is_half_open(one):
    assert value(one, text.slice_text(F.lit("abcdef"), 1, 3)) == "bc"
    assert value(one, text.slice_text(F.lit("ab"), 1, 9)) == "b"


def test_parse_date(one):
    assert value(one, temporal.parse_date(F.lit("20250706"))) == dt.date(2025, 7, 6)
    assert value(one, temporal.parse_date(F.lit("2025xx06"))) is None


@pytest.mark.parametrize("day, number, weekend", [("2025-07-06", 6, 1), ("2025-07-07", 0, 0), ("2025-07-05", 5, 1)])
def test_weekday(one, day, number, weekend):
    moment = F.to_date(F.lit(day))
    assert value(one, temporal.weekday(moment)) == number
    assert value(one, temporal.is_weekend(moment)) == weekend


@pytest.mark.parametrize(
    "start, stop, seconds",
    [
        ("2025-01-01 00:00:00", "2025-01-01 00:00:00", 0),
        ("2025-01-01 00:00:00", "2025-01-01 00:00:00.999", 0),
        ("2025-01-01 00:00:00", "2025-01-31 00:00:00", 30 * 86400),
        ("2025-01-01 00:00:01.5", "2025-01-01 00:00:00", -1),
    ],
)
def test_duration(one, start, stop, seconds):
    for kind in ("timestamp", "timestamp_ntz"):
        a, b = F.lit(start).cast(kind), F.lit(stop).cast(kind)
        assert value(one, temporal.duration_seconds(a, b)) == seconds


@pytest.mark.parametrize("x, cell", [(-73.987, -73.99), (0.0, 0.0), (0.05, 0.05), (-0.001, -0.01)])
def test_grid_floor(one, x, cell):
    assert value(one, geo.grid_floor(F.lit(x))) == pytest.approx(cell)


def test_haversine(one):
    quarter = geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0))
    assert value(one, quarter) == pytest.approx(6371 * math.pi / 2)
    opposite = geo.haversine_km(F.lit(10.0), F.lit(0.0), F.lit(-170.0), F.lit(0.0))
    assert value(one, opposite) == pytest.approx(6371 * math.pi)


def test_point(one):
    assert tuple(value(one, geo.point(F.lit(1), F.lit(2)))) == (1.0, 2.0)


@pytest.mark.parametrize("x, whole", [(0.5, 0), (1.5, 2), (2.5, 2), (-0.5, 0), (0.49, 0)])
def test_round_half_even(one, x, whole):
    assert value(one, numeric.round_half_even(F.lit(x))) == whole


def test_sigmoid_limits(one):
    assert value(one, numeric.sigmoid(F.lit(0.0))) == 0.5
    assert value(one, numeric.sigmoid(F.lit(800.0))) == 1.0
    assert value(one, numeric.sigmoid(F.lit(-800.0))) == 0.0


def test_vectors(one):
    v = F.array(*[F.lit(x) for x in (1.0, 3.0, 3.0, -2.0)])
    w = F.array(*[F.lit(x) for x in (1.0, 0.0, 3.0, 2.0)])
    assert value(one, vectors.argmax(v)) == 1
    assert value(one, vectors.l2_distance(v, w)) == pytest.approx(5.0)
    assert value(one, vectors.dot(v, w)) == pytest.approx(6.0)
    assert value(one, vectors.every_kth(v, 3)) == [1.0, -2.0]
    assert value(one, vectors.scale_by(v, [1, 2, 0, -1])) == [1.0, 6.0, 0.0, 2.0]
    assert value(one, vectors.normalize(v, 1.0, 2.0)) == [0.0, 1.0, 1.0, -1.5]


def test_softmax_of_large_values(one):
    v = F.array(F.lit(1000.0), F.lit(1000.0), F.lit(-1000.0))
    assert value(one, vectors.softmax(v)) == pytest.approx([0.5, 0.5, 0.0])
    assert value(one, vectors.cross_entropy(v, F.lit(0))) == pytest.approx(math.log(2))


def test_channels_have_their_own_mean_and_deviation(one):
    v = F.array(*[F.lit(float(x)) for x in (1, 3, 10, 30)])
    channels = vectors.channels_of(v, 2)
    assert value(one, vectors.normalize_channels(channels, [1.0, 10.0], [2.0, 20.0])) == [[0.0, 1.0], [0.0, 1.0]]
    with pytest.raises(Exception, match="expected 3 channels"):
        value(one, vectors.normalize_channels(channels, [1.0, 2.0, 3.0], [1.0, 1.0, 1.0]))
