import math

import pytest
from pyspark.sql import functions as F

from terrella.operators import aggregates, metrics


def scored(spark, rows):
    return spark.createDataFrame(rows, "y INT, p INT")


def both(df):
    return df, F.col("p"), F.col("y")


def test_nothing_predicted_positive(spark):
    df = scored(spark, [(1, 0), (1, 0), (0, 0)])
    row = metrics.sensitivity_specificity(*both(df)).first()
    assert (row["sensitivity"], row["specificity"]) == (0.0, 1.0)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(*both(df)).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 2, (1, 1): 0}
    report = {r["label"]: r for r in metrics.classification_report(*both(df)).collect()}
    assert report["1"]["precision"] == report["1"]["recall"] == report["1"]["f1"] == 0.0
    assert report["accuracy"]["f1"] == pytest.approx(1 / 3)


def test_specificity_without_negatives(spark):
    row = metrics.sensitivity_specificity(*both(scored(spark, [(1, 1)]))).first()
    assert (row["sensitivity"], row["specificity"]) == (1.0, 0.0)


@pytest.mark.parametrize(
    "rows, auc",
    [
        ([(0.3, 0), (0.3, 1), (0.3, 1)], 0.5),
        ([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], 1.0),
        ([(0.9, 0), (0.1, 1)], 0.0),
        ([(0.1, 0), (0.5, 0), (0.5, 1), (0.9, 1)], 0.875),
    ],
)
def test_roc_auc(spark, rows, auc):
    df = spark.createDataFrame(rows, "s DOUBLE, y INT")
    assert metrics.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(auc)


def test_roc_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(spark.createDataFrame([(0.1, 1)], "s DOUBLE, y INT"), "s", "y").first()["auc"] is None


def test_roc_auc_against_all_pairs(spark):
    rows = [(math.sin(i * 1.7) + (i % 3) * 0.2, int(i % 3 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "s DOUBLE, y INT")
    ups, downs = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((u > d) + 0.5 * (u == d) for u in ups for d in downs)
    assert metrics.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(won / len(ups) / len(downs))


def test_diff_count(spark):
    a = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 1.0)], "k INT, v DOUBLE")
    b = spark.createDataFrame([(1, 0.5), (2, 1e-7), (4, 1.0)], "k INT, v DOUBLE")
    # One real difference, and two keys that exist on one side only.
    assert aggregates.diff_count(a, b, ["k"], "v", 1e-6).first()["n_diff"] == 3


def test_total_of_four_ones(spark):
    ones = spark.range(4).select(F.lit(1).alias("v"))
    assert [r["total"] for r in aggregates.with_total(ones, "v").collect()] == [4] * 4


def test_gather_in_blocks(spark):
    rows = spark.range(10).select(F.lit("a").alias("owner"), "id", (F.col("id") * 2).alias("v"))
    got = aggregates.gather_ordered(rows.repartition(5), ["owner"], "id", "v", block=4).orderBy("block").collect()
    assert [r["pieces"] for r in got] == [[0, 2, 4, 6], [8, 10, 12, 14], [16, 18]]


def test_integral_is_pi(spark):
    cells = spark.range(100_000)
    got = aggregates.midpoint_integral(cells, "id", F.lit(100_000)).first()["integral"]
    assert got == pytest.approx(math.pi, abs=1e-9)


def test_population_without_rows_counts(spark):
    sums = spark.createDataFrame([("c", 1, 6.0)], "city STRING, year INT, v DOUBLE")
    people = spark.createDataFrame([("c",), ("c",), ("c",)], "city STRING")
    got = aggregates.normalized_group_sum(sums, ["city", "year"], "v", people, ["city"]).first()
    assert got["total"] == 2.0


def test_covariance_is_symmetric(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.sin("id").alias("b"))
    got = {(r["row"], r["col"]): r["cov"] for r in aggregates.covariance_matrix(df, ["a", "b"]).collect()}
    assert got[0, 1] == got[1, 0]
    assert got[0, 0] == pytest.approx(212.5)


def test_cross_entropy_and_error(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], 1), (0, [50.0, 0.0], 0)], "e INT, z ARRAY<DOUBLE>, y INT")
    assert metrics.epoch_loss(df, F.col("e"), "z", "y").first()["loss"] == pytest.approx(math.log(2))
    margins = spark.createDataFrame([(2.0, 1), (-1.0, 1), (0.0, 0), (3.0, 0)], "m DOUBLE, y INT")
    assert metrics.margin_error(margins, "m", "y").first()["error"] == 0.5


def test_confusion_matrix_keeps_every_label(spark):
    rows = spark.createDataFrame([(0, 0), (1, 2), (None, 1)], "actual int, predicted int")
    cells = metrics.confusion_matrix(rows, F.col("predicted"), F.col("actual")).collect()
    assert len(cells) == 10 and sum(r["n"] for r in cells) == 3
    assert {(r["actual"], r["predicted"]) for r in cells if r["n"]} == {(0, 0), (1, 2), (None, 1)}


def test_vector_covariance(spark):
    rows = [([1.0, 2.0],), ([3.0, 2.0],), ([5.0, 8.0],), (None,)]
    df = spark.createDataFrame(rows, "v ARRAY<DOUBLE>")
    got = {(r["row"], r["col"]): round(r["cov"], 9) for r in aggregates.vector_covariance(df, "v").collect()}
    assert got == {(0, 0): 4.0, (0, 1): 6.0, (1, 0): 6.0, (1, 1): 12.0}
    with pytest.raises(ValueError, match="different lengths"):
        aggregates.vector_covariance(df.union(spark.createDataFrame([([1.0],)], "v ARRAY<DOUBLE>")), "v")
    assert aggregates.vector_covariance(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("rows_per_chunk", [1, 7, 10**6])
def test_offsets_in_two_levels(spark, monkeypatch, rows_per_chunk):
    """Chunks follow the rows; their sums are added inside stretches and over them."""
    from terrella.operators import positions, windows

    monkeypatch.setattr(positions, "STRETCH", 4)
    monkeypatch.setattr(positions.chunk_count, "__defaults__", (rows_per_chunk,))
    owners = [(i * 7) % 45 for i in range(200)] + [None] * 3
    frame = spark.createDataFrame([(o,) for o in owners], "owner int")
    chunks = positions.quantile_chunks(frame, "owner").select("_chunk").distinct().count()
    assert chunks > 16 if rows_per_chunk == 1 else chunks <= 65
    got = {r["owner"]: (r["n"], r["offset"]) for r in windows.block_offsets(frame, "owner").collect()}
    before = 0
    for owner in [None, *range(45)]:
        assert got[owner] == (owners.count(owner), before)
        before += owners.count(owner)


def test_many_centers_come_in_blocks(spark):
    import numpy as np

    from terrella.operators.metrics import nearest_center

    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(50, 3)), rng.normal(size=(40, 3))
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "id int, v array<double>")
    centers = spark.createDataFrame([([float(v) for v in r],) for r in c] + [(None,)], "center array<double>")
    want = ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1)
    for max_bytes in (1 << 20, 300):
        got = {r["id"]: r["distance2"] for r in nearest_center(frame, "v", centers, max_bytes=max_bytes).collect()}
        assert np.allclose([got[i] for i in range(50)], want) and got[99] is None


def test_a_heavy_key_is_ranked_in_ranges(spark):
    from terrella.operators.ordering import ranked_sort

    frame = spark.range(300).selectExpr("id % 10 DIV 8 AS k", "CAST(299 - id AS INT) AS o").repartition(5)
    got = ranked_sort(frame, ["k"], ["o"], task_rows=40, sample_fraction=1.0).collect()
    want = sorted((r["k"], r["o"]) for r in frame.collect())
    assert [(r["k"], r["o"]) for r in got] == want
    assert [r["rank"] for r in got] == [*range(1, 241), *range(1, 61)]
