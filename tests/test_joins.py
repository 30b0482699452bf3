import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrella.operators import joins, knn
from terrella.operators.skew import salted_join


def km(a, b):
    (lon1, lat1), (lon2, lat2) = a, b
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


PLACES = {
    "town": lambda r: (10 + r.random(120) * 0.4, 50 + r.random(120) * 0.3),
    "date line": lambda r: (((179.8 + r.random(120) * 0.4) + 180) % 360 - 180, -5 + r.random(120) * 0.3),
    "north pole": lambda r: (r.random(120) * 360 - 180, 89.6 + r.random(120) * 0.4),
    "south": lambda r: (r.random(150) * 20 - 180, -88 + r.random(150) * 2),
}


@pytest.mark.parametrize("place", PLACES)
@pytest.mark.parametrize("radius", [3.0, 12.0])
@pytest.mark.parametrize("task_rows", [20_000, 2])
def test_fixed_radius_pairs(spark, place, radius, task_rows):
    lon, lat = PLACES[place](np.random.default_rng(3))
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(lon, lat))]
    df = spark.createDataFrame(points, "id LONG, lon DOUBLE, lat DOUBLE").repartition(3)
    got = sorted((r["id1"], r["id2"]) for r in joins.fixed_radius_pairs(df, radius, task_rows=task_rows).collect())
    want = [(a[0], b[0]) for a, b in itertools.combinations(points, 2) if km(a[1:], b[1:]) <= radius]
    assert got == want


def test_huge_radius_meets_everyone(spark):
    points = [(0, 0.0, 0.0), (1, 180.0, 0.0), (2, 90.0, -90.0)]
    df = spark.createDataFrame(points, "id LONG, lon DOUBLE, lat DOUBLE")
    assert joins.fixed_radius_pairs(df, 30_000.0).count() == 3


def test_literal_centers_equal_the_cell_join(spark, tables):
    from terrella.plans.rainfall import CITIES, RADIUS_KM

    near = joins.near_centers(tables.stations, CITIES, RADIUS_KM).select("station_id", "center")
    centers = spark.createDataFrame([(n, x, y) for n, (x, y) in CITIES.items()], "id STRING, lon DOUBLE, lat DOUBLE")
    points = tables.stations.select(F.col("station_id").alias("id"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    pairs = joins.within_radius(points, centers, RADIUS_KM).select("id1", "id2")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, pairs.collect()))


def test_salted_join_keeps_every_row(spark):
    # A third of the left rows are full copies of one row.
    left = spark.range(900, numPartitions=9).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"),
    )
    right = spark.range(-1, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(
        spark.createDataFrame([(-1, 7)], "k LONG, w LONG")
    )
    salted = salted_join(left, right, ["k"], ["v"], task_rows=10)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_salts_reach_many_tasks(spark):
    left = spark.range(4000, numPartitions=8).select((F.col("id") * 0 + 1).alias("k"), F.lit(0).alias("v"))
    right = spark.createDataFrame([(1, 2)], "k LONG, w INT")
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = salted_join(left, right, ["k"], ["v"], task_rows=100)
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 4000


def test_salted_join_cuts_a_side_that_is_heavy_on_the_right(spark):
    left = spark.createDataFrame([(1, v) for v in range(3)] + [(None, 9)], "k LONG, v LONG")
    right = spark.range(1200, numPartitions=6).select(
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("w")
    )
    salted = salted_join(left, right, ["k"], ["v"], task_rows=100)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString() and salted.columns == ["k", "v", "w"]


def test_only_the_list_of_heavy_keys_is_broadcast(spark):
    # Both sides are estimated far below the broadcast threshold; copies made above them are not in the estimate.
    points = spark.range(40).select("id", (F.col("id") % 7 / 20).alias("lon"), (F.col("id") % 5 / 20).alias("lat"))
    plan = joins.fixed_radius_pairs(points, 10.0)._jdf.queryExecution().executedPlan().toString()
    nodes = [line.strip(" +-:") for line in plan.splitlines()]
    joined = [n for n in nodes if "Join" in n.split("(")[0].split("[")[0]]
    inner = [n for n in joined if ", Inner" in n]
    assert len(inner) >= 2 and all(n.startswith("SortMergeJoin") for n in inner)
    assert all("LeftOuter" in n for n in joined if n.startswith("Broadcast"))


def test_broadcast_only_below_the_bound(spark):
    def hinted(df, max_bytes):
        return "broadcast" in joins.broadcast_if_small(df, max_bytes)._jdf.queryExecution().logical().toString()

    assert hinted(spark.range(10), 160) and not hinted(spark.range(10), 159)
    # Long texts and arrays count with what they hold.
    texts = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert hinted(texts, 10_160) and not hinted(texts, 10_000)
    arrays = spark.range(10).select(F.sequence(F.lit(1), F.lit(500)).alias("a"))
    assert not hinted(arrays, 10_000)


def test_lookup_join_result_does_not_depend_on_the_bound(spark):
    facts = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    lookup = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    few = joins.lookup_join(facts, lookup, ["k"], max_bytes=1)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, joins.lookup_join(facts, lookup, ["k"]).collect()))


def test_value_reaches_every_part(spark):
    value = spark.createDataFrame([(42,)], "v INT")
    got = joins.broadcast_scalar(spark.range(8, numPartitions=4), value, "v").collect()
    assert [r["v"] for r in got] == [42] * 8


@pytest.mark.parametrize("task_rows", [100_000, 2])
def test_matmul(spark, task_rows):
    rng = np.random.default_rng(5)
    a, b = rng.random((6, 9)), rng.random((9, 4))

    def table(m, names):
        rows = [(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]
        return spark.createDataFrame(rows, names)

    got = joins.matmul(table(a, "i INT, k INT, v DOUBLE"), table(b, "k INT, j INT, v DOUBLE"), task_rows)
    product = np.zeros((6, 4))
    for r in got.collect():
        product[r["i"], r["j"]] = r["v"]
    assert np.allclose(product, a @ b)


def vectors(spark, matrix, first=0):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>").repartition(5)


def brute(index, queries, k):
    found = {}
    for q, v in enumerate(queries):
        d = np.sqrt(((index.astype(np.float32).astype(float) - v.astype(np.float32).astype(float)) ** 2).sum(axis=1))
        found[q] = sorted(zip(d.tolist(), range(len(index))))[:k]
    return found


@pytest.mark.parametrize("query_bytes", [knn.QUERY_BYTES, 0])
def test_knn_against_brute_force(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(knn, "INDEX_BLOCK", 100)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 20)
    monkeypatch.setattr(knn, "_TILE_QUERIES", 7)
    monkeypatch.setattr(knn, "_TILE_ROWS", 13)
    rng = np.random.default_rng(1)
    index, queries = rng.normal(size=(300, 8)), rng.normal(size=(50, 8))
    index[100:110] = index[7]  # equal distances
    queries[0] = index[7]
    got = knn.k_nearest(vectors(spark, index), vectors(spark, queries), 6, query_bytes=query_bytes).collect()
    want = brute(index, queries, 6)
    assert len(got) == 300
    for r in got:
        distance, row = want[r["query_id"]][r["rank"] - 1]
        assert r["index_id"] == row and r["distance"] == pytest.approx(distance, abs=1e-9)


@pytest.mark.parametrize("query_bytes", [knn.QUERY_BYTES, 0])
def test_knn_with_k_above_the_index(spark, query_bytes):
    index = vectors(spark, np.eye(3))
    got = knn.k_nearest(index, index, 10, query_bytes=query_bytes).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["index_id"]) for r in got] == [(0, 0), (0, 1), (0, 2), (1, 1), (1, 0), (1, 2), (2, 2), (2, 0), (2, 1)]


def test_knn_without_queries(spark):
    index = vectors(spark, np.eye(3))
    assert knn.k_nearest(index, index.filter("vec_id < 0"), 2).count() == 0


def test_knn_on_all_embeddings(spark, tables):
    table = tables.embeddings
    rows = table.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    matrix = np.stack(rows["embedding"].to_numpy()).astype(float)
    got = knn.k_nearest(table, table, 6).toPandas()
    first = got[got["rank"] == 1]
    assert (first["distance"] < 1e-9).all()
    exact = np.sort(np.sqrt(((matrix[:, None, :] - matrix[None, :, :]) ** 2).sum(axis=2)), axis=1)[:, :6]
    ours = got.sort_values(["query_id", "rank"])["distance"].to_numpy().reshape(-1, 6)
    assert np.allclose(ours, exact, atol=1e-9)


@pytest.mark.parametrize("query_bytes", [knn.QUERY_BYTES, 0])
def test_knn_leaves_out_null_vectors_and_refuses_ragged_ones(spark, query_bytes):
    schema = "vec_id LONG, embedding ARRAY<DOUBLE>"
    index = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (None, [0.0, 1.0]), (3, [3.0, 4.0])], schema)
    got = knn.k_nearest(index, index.filter("vec_id = 1"), 3, query_bytes=query_bytes)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, 0.0), (1, 2, 3, 5.0)]
    ragged = index.union(spark.createDataFrame([(4, [1.0])], schema)).coalesce(1)
    with pytest.raises(Exception, match="different lengths|reshape|align|mismatch"):
        knn.k_nearest(ragged, index.filter("vec_id = 1"), 3, query_bytes=query_bytes).collect()
