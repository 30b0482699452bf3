"""Dense tiles and kNN in passes, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.operators import knn, matrix


def cells(spark, m, names):
    i, j = np.nonzero(m)
    return spark.createDataFrame([(int(a), int(b), float(m[a, b])) for a, b in zip(i, j)], f"{names[0]} long, {names[1]} long, v double").repartition(5)


def dense(frame, shape):
    out = np.zeros(shape)
    for r in frame.collect():
        assert out[r["i"], r["j"]] == 0
        out[r["i"], r["j"]] = r["v"]
    return out


@pytest.mark.parametrize("tile, depth", [(4, 1), (4, 3), (5, 2), (64, 64)])
def test_products_match_numpy(spark, tile, depth):
    rng = np.random.default_rng(tile)
    a, b = rng.normal(size=(13, 22)) * (rng.random((13, 22)) < 0.6), rng.normal(size=(22, 9)) * (rng.random((22, 9)) < 0.6)
    a[:, 8:16] = 0  # whole tiles without a cell
    got = matrix.matmul_blocks(cells(spark, a, "ik"), cells(spark, b, "kj"), tile, depth)
    assert np.allclose(dense(got, (13, 9)), a @ b)


def test_tiles_add_repeated_cells_and_keep_their_place(spark):
    rows = [(-3, 7, 1.5), (-3, 7, 2.0), (100, 0, None), (None, 1, 3.0), (2, None, 3.0), (2, 2, -1.0)]
    tiles = matrix.to_tiles(spark.createDataFrame(rows, "i long, j long, v double"), "i", "j", "v", tile=4)
    assert sorted((r["i"], r["j"], r["v"]) for r in matrix.from_tiles(tiles, tile=4).collect()) == [(-3, 7, 3.5), (2, 2, -1.0)]
    empty = spark.createDataFrame([], "i long, k long, v double")
    assert matrix.matmul_blocks(empty, cells(spark, np.eye(3), "kj"), 4).count() == 0


def test_one_long_inner_dimension_is_cut_into_stretches(spark):
    ones = spark.range(1000).select(F.lit(0).alias("i"), F.col("id").alias("k"), F.lit(1.0).alias("v"))
    tiles = [matrix.to_tiles(f, *c, "v", 10) for f, c in ((ones, ("i", "k")), (ones.withColumnRenamed("i", "j"), ("k", "j")))]
    product = matrix.multiply_tiles(*tiles, tile=10, depth=4)
    assert matrix.from_tiles(product, 10).collect() == [(0, 0, 1000.0)]


def test_rows_of_a_tiled_matrix_hold_its_cells_only(spark):
    # A tile each 64 places along the diagonal has few cells, one full tile has all.
    few = spark.range(0, 6400, 64).select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(2.0).alias("v"))
    full = spark.range(64 * 64).select((F.col("id") % 64 + 6400).alias("i"), F.floor(F.col("id") / 64).alias("j"), F.lit(3.0).alias("v"))
    tiles = matrix.to_tiles(few.union(full), "i", "j", "v", tile=64)
    assert tiles.select(F.sum(F.size("data")), F.max(F.size("data"))).first() == (100 + 64 * 64, 64)
    assert sorted(map(tuple, matrix.from_tiles(tiles, 64).collect())) == sorted(map(tuple, few.union(full).collect()))


# Neighbours in passes


def vectors(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<double>").repartition(3)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    spots = rng.normal(size=(6, 5)) * 20
    near = spots[rng.integers(0, 6, 400)] + rng.normal(size=(400, 5))
    return np.vstack([near, near[:40]])  # and some full copies


@pytest.mark.parametrize("pass_bytes, cells_", [(1 << 30, 4), (2000, 16), (1, 1)])
def test_passes_find_what_one_pass_finds(spark, points, monkeypatch, pass_bytes, cells_):
    monkeypatch.setattr(knn, "_TILE_QUERIES", 16)
    monkeypatch.setattr(knn, "_TILE_ROWS", 50)
    index, queries = vectors(spark, points), vectors(spark, points[::40])
    got = knn.k_nearest_in_passes(index, queries, 7, pass_bytes=pass_bytes, cells=cells_).collect()
    gaps = np.sqrt(((points[::40][:, None] - points[None]) ** 2).sum(axis=2))
    for q in range(len(points[::40])):
        want = sorted((round(d, 9), i) for i, d in enumerate(gaps[q]))[:7]
        found = sorted((r["rank"], round(r["distance"], 9), r["index_id"]) for r in got if r["query_id"] == q)
        assert [(d, i) for _, d, i in found] == want


def test_the_index_is_not_shuffled(spark, points, monkeypatch):
    plans = []
    monkeypatch.setattr(knn, "keep", lambda frame, label: plans.append(frame._jdf.queryExecution().toString()) or frame)
    knn.k_nearest_in_passes(vectors(spark, points).select("vec_id", "embedding"), vectors(spark, points[:3]), 2)
    below = plans[0].split("== Physical Plan ==")[1].split("MapInArrow")[1]
    assert below.count("Exchange") <= 1  # the test's own repartition


def test_passes_run_side_by_side(spark, points, monkeypatch):
    index, queries = vectors(spark, points), vectors(spark, points[:100])
    plans = []
    kept = knn.keep
    monkeypatch.setattr(knn, "keep", lambda frame, label: plans.append(frame._jdf.queryExecution().toString()) or kept(frame, label))
    monkeypatch.setattr(knn, "ROUND_BYTES", 10 * 400)
    got = knn.k_nearest_in_passes(index, queries, 3, pass_bytes=400).collect()  # ten passes
    assert len(plans) == 1 and plans[0].split("== Physical Plan ==")[1].count("MapInArrow") == spark.sparkContext.defaultParallelism
    key = lambda r: (r["query_id"], r["rank"])
    assert sorted(got, key=key) == sorted(knn.k_nearest(index, queries, 3).collect(), key=key)


def test_cells_met_as_a_whole_give_the_same(points, monkeypatch):
    monkeypatch.setattr(knn, "_TILE_ROWS", 64)
    wide = np.random.default_rng(7).normal(size=(900, 40))  # no cell is far from any query
    for rows in (points, wide):
        pruned, plain = knn._PrunedSearch(np.arange(150), rows[:150], 5, 16), knn._Search(np.arange(150), rows[:150], 5)
        for search in (pruned, plain):
            search.add(np.arange(len(rows)), rows)
        assert all(a.equals(b) for a, b in zip(pruned.columns(), plain.columns()))


def test_far_cells_are_skipped(points):
    order = np.argsort(knn.nearest_pivot(points, points[:30])[0], kind="stable")
    search = knn._PrunedSearch(np.arange(20), points[:20], 3, 16)
    search.add(np.arange(len(points)), points[order])
    assert search.skipped > search.met / 4
    assert knn.nearest_pivot(points[:5], points[:5])[0].tolist() == [0, 1, 2, 3, 4]


def test_rows_laid_near_each_other_are_the_same_rows(spark, points):
    index = vectors(spark, points).union(spark.createDataFrame([(999, None)], "vec_id long, embedding array<double>"))
    laid = knn.near_each_other(index, pivots=8)
    assert sorted(r["vec_id"] for r in laid.collect()) == sorted([*range(len(points)), 999])
    queries = vectors(spark, points[:9])
    key = lambda r: (r["query_id"], r["rank"])
    assert sorted(knn.k_nearest_in_passes(laid, queries, 4).collect(), key=key) == sorted(knn.k_nearest(index, queries, 4).collect(), key=key)
    assert knn.near_each_other(index.limit(0)).count() == 0
    assert knn.k_nearest_in_passes(index, queries.limit(0), 4).count() == 0
