"""Least squares by QR, components by power iteration, exact splits: against numpy and by counting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.functions.numeric import drawn_bits
from terrella.learning import factors, models, splits
from terrella.operators.aggregates import vector_covariance
from terrella.sources import generators


@pytest.fixture(scope="module")
def rows(spark):
    x = [generators.normal(F.col("id"), 51, i) for i in range(4)]
    return spark.range(301).select("id", F.array(x[0], x[1] * 3 + x[0], x[2] - 2, x[3] * 0.1).alias("f"), (x[0] - 2 * x[2] + 0.3 * x[3] + 4).alias("y"))


@pytest.mark.parametrize("parts, fan_in", [(1, 32), (7, 2), (11, 3)])
def test_least_squares_match_numpy(rows, parts, fan_in):
    line = factors.least_squares(rows.repartition(parts), "f", "y", fan_in)
    found = rows.collect()
    x = np.column_stack([np.ones(301), [r["f"] for r in found]])
    want, residual, rank, _ = np.linalg.lstsq(x, [r["y"] for r in found], rcond=None)
    assert np.allclose([line.intercept, *line.coefficients], want, atol=1e-10)
    assert line.residual == pytest.approx(float(residual[0]), abs=1e-9) and (line.rank, line.rows) == (rank, 301)
    told = rows.withColumn("p", line.predict(F.col("f"))).collect()
    assert np.allclose([r["p"] for r in told], x @ want)


def test_nearly_collinear_features_keep_their_digits(spark):
    x = generators.uniform(F.col("id"), 1)
    near = x + 1e-8 * generators.uniform(F.col("id"), 2)
    frame = spark.range(2000).select(F.array(x, near).alias("f"), (2 * x - 3 * near + 1).alias("y"))
    line = factors.least_squares(frame.repartition(5), "f", "y")
    assert np.allclose(line.coefficients, [2, -3], atol=1e-5)
    squared = models.fit_line(models.vectors(frame, "f", "v"), "y", "v")
    assert abs(squared.coefficients[0] - 2) > 1e-3  # what the normal equations make of it


def test_features_without_a_share_of_their_own(spark):
    frame = spark.range(50).select(F.array(F.col("id") + 0.0, 2.0 * F.col("id"), F.lit(5.0)).alias("f"), (F.col("id") * 5.0 + 1).alias("y"))
    line = factors.least_squares(frame, "f", "y")
    assert line.rank == 2 and line.residual < 1e-9
    assert all(abs(r["p"] - r["y"]) < 1e-6 for r in frame.withColumn("p", line.predict(F.col("f"))).collect())


def test_rows_that_do_not_fit_are_left_out(spark):
    good = [([float(i), float(i * i)], 2.0 * i + 1) for i in range(6)]
    odd = [(None, 1.0), ([1.0], 5.0), ([None, 1.0], 5.0), ([1.0, 2.0], None), ([], 1.0)]
    frame = spark.createDataFrame(good + odd, "f array<double>, y double")
    line = factors.least_squares(frame, "f", "y")
    assert line.rows == 6 and np.allclose(line.coefficients, [2, 0]) and line.intercept == pytest.approx(1)
    assert factors.principal_components(frame, "f", k=1).means.tolist() == pytest.approx([16 / 7, 57 / 7])
    for bad in (frame.limit(0), frame.filter("y is null and f is null")):
        with pytest.raises(ValueError):
            factors.least_squares(bad, "f", "y")
    with pytest.raises(ValueError):
        factors.principal_components(frame.limit(1), "f")


def test_components_agree_with_the_covariance(spark, tables):
    found = factors.principal_components(tables.embeddings.repartition(7), "embedding", k=3, spare=40, passes=200, fan_in=2)
    matrix = np.zeros((64, 64))
    for r in vector_covariance(tables.embeddings, "embedding").collect():
        matrix[r[0], r[1]] = matrix[r[1], r[0]] = r[2]
    values, axes = np.linalg.eigh(matrix)
    assert np.allclose(found.variances, values[::-1][:3], rtol=1e-6)
    assert np.allclose(np.abs(found.axes @ axes[:, ::-1][:, :3]), np.eye(3), atol=1e-2)
    moments = tables.embeddings.withColumn("p", found.project(F.col("embedding"))).select(
        *[F.var_samp(F.get("p", F.lit(i))).alias(f"v{i}") for i in range(3)], F.avg(F.get("p", F.lit(0))).alias("m")
    ).first()
    assert np.allclose(moments[:3], found.variances, rtol=1e-6) and abs(moments[3]) < 1e-9


def test_components_of_many_columns(spark):
    """Two directions in 20,000 columns: no matrix of width by width is made."""
    width = 20_000
    wave = lambda s: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.sin(j * s))
    a, b = generators.normal(F.col("id"), 1), generators.normal(F.col("id"), 2)
    frame = spark.range(40).select(F.zip_with(wave(0.01), wave(0.7), lambda x, y: 5 * a * x + b * y).alias("f"))
    found = factors.principal_components(frame.repartition(4), "f", k=2, spare=2)
    x = np.array([r["f"] for r in frame.collect()])
    singular = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert np.allclose(found.variances, singular[:2] ** 2 / 39, rtol=1e-6)


# Exact splits


@pytest.mark.parametrize("share", [0.0, 0.1, 0.25, 0.999, 1.0])
def test_exactly_the_share_is_test_rows(spark, share):
    frame = spark.range(997).withColumn("x", F.lit("kept"))
    train, test = splits.split_exact(frame.repartition(6), ["id"], share, seed=5)
    assert test.count() == round(997 * share) and test.columns == ["id", "x"]
    ids = [r["id"] for r in train.collect()] + [r["id"] for r in test.collect()]
    assert sorted(ids) == list(range(997))
    again = splits.split_exact(frame.coalesce(1), ["id"], share, seed=5)[1]
    assert {r["id"] for r in again.collect()} == {r["id"] for r in test.collect()}


def test_full_copies_are_split_exactly(spark):
    frame = spark.range(900).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).alias("k"))
    for share in (0.1, 0.37, 0.5, 0.8):
        train, test = splits.split_exact(frame.repartition(5), ["k"], share, seed=1)
        assert (test.count(), train.count()) == (round(900 * share), 900 - round(900 * share))
    assert splits.split_exact(frame.limit(0), ["k"], 0.5, seed=1)[1].count() == 0
    with pytest.raises(ValueError):
        splits.split_exact(frame, ["k"], 1.5, seed=1)


def test_the_kth_smallest_draw(spark):
    drawn = spark.range(500).select(drawn_bits(15, F.col("id"), 1).alias("d")).union(spark.range(20).select(F.lit(7).cast("long").alias("d")))
    values = sorted(r["d"] for r in drawn.collect())
    for k in (1, 5, 20, 21, 300, 520):
        found, below = splits.kth_smallest(drawn, "d", k)
        assert found == values[k - 1] and below == sum(v < found for v in values)
