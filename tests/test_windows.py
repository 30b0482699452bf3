from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from terrella.operators import ordering, positions, windows

#: Makes groups above 30 rows heavy, counted exactly.
SPLIT = {"task_rows": 30, "sample_fraction": 1.0}
PLAIN = {}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 900 rows belong to one key; order values repeat."""
    return spark.range(900, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1).alias("k"),
        ((F.col("id") * 7919) % 100).alias("o"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 1.5).alias("v"),
    )


def test_the_heavy_path_is_taken(skewed):
    from terrella.operators.skew import split_heavy

    cold, hot = split_heavy(skewed, ["k"], **SPLIT)
    assert {r["k"] for r in hot.select("k").distinct().collect()} == {0}
    assert cold.count() + hot.count() == 900
    assert split_heavy(skewed, ["k"])[1] is None


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize(
    "operator",
    [
        lambda df, o: positions.number_in_group(df, ["k"], ["o", "id"], "p", "n", **o),
        lambda df, o: windows.balanced_blocks(df, ["k"], ["o", "id"], 7, **o),
        lambda df, o: windows.neighbour(df, ["k"], ["o", "id"], "v", 777.0, **o),
        lambda df, o: windows.every_kth_row(df, ["k"], ["o", "id"], 4, **o),
        lambda df, o: windows.assign_batches(df, "k", ["o", "id"], 8, **o),
        lambda df, o: windows.assign_batches(df, "k", ["o", "id"], 8, drop_last=True, **o),
    ],
    ids=["number", "blocks", "neighbour", "every_kth", "batches", "full_batches"],
)
def test_heavy_groups_give_the_same_rows(skewed, operator):
    assert rows(operator(skewed, SPLIT)) == rows(operator(skewed, PLAIN))
    # The heavy key can be null.
    nulls = skewed.withColumn("k", F.when(F.col("k") != 0, F.col("k")))
    assert rows(operator(nulls, SPLIT)) == rows(operator(nulls, PLAIN))


@pytest.mark.parametrize("tied", [5, None])
def test_one_order_value_in_a_heavy_group_is_cut_as_well(skewed, tied):
    same = skewed.withColumn("o", F.lit(tied).cast("bigint"))
    for operator in (
        lambda o: positions.number_in_group(same, ["k"], ["o", "id"], "p", "n", **o),
        lambda o: windows.neighbour(same, ["k"], ["o", "id"], "v", 777.0, **o),
    ):
        assert rows(operator(SPLIT)) == rows(operator(PLAIN))
    chunks = positions.range_chunks(same.filter("k = 0"), ["k", "o", "id"], 30).groupBy(positions.CHUNK).count().collect()
    assert len(chunks) == 10 and max(r["count"] for r in chunks) < 60


def test_a_null_key_is_heavy_too(skewed):
    from terrella.operators.skew import split_heavy

    nulls = skewed.withColumn("k", F.when(F.col("k") != 0, F.col("k")))
    cold, hot = split_heavy(nulls, ["k"], **SPLIT)
    assert {r["k"] for r in hot.select("k").distinct().collect()} == {None}
    assert hot.count() == 300 and cold.count() == 600


@pytest.mark.parametrize("n, owners, sizes", [(10, 4, [3, 3, 2, 2]), (2, 4, [1, 1]), (8, 4, [2] * 4)])
def test_block_sizes(spark, n, owners, sizes):
    got = windows.balanced_blocks(spark.range(n).withColumn("k", F.lit(1)), ["k"], ["id"], owners)
    owned = Counter(r["owner"] for r in got.orderBy("id").collect())
    assert [owned[i] for i in sorted(owned)] == sizes


def test_first_neighbour_is_the_default(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, 6.0)], "k INT, o INT, v DOUBLE")
    got = windows.neighbour(df, ["k"], ["o"], "v", 777.0).orderBy("o").collect()
    assert [r["previous"] for r in got] == [777.0, None, 5.0]


def test_block_offsets(spark):
    df = spark.createDataFrame([(5,)] * 3 + [(1,)] * 2 + [(9,)], "owner INT")
    got = windows.block_offsets(df, "owner").orderBy("owner").collect()
    assert [tuple(r) for r in got] == [(1, 2, 0), (5, 3, 2), (9, 1, 5)]


@pytest.mark.parametrize("n, shards", [(103, 8), (64, 8), (3, 8), (1, 4)])
def test_epoch_shards(spark, n, shards):
    got = windows.epoch_shards(spark.range(n), "id", epoch=1, shards=shards).collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    want = -(-n // shards)
    assert sorted(by_shard) == list(range(shards))
    assert all(sorted(slots) == list(range(want)) for slots in by_shard.values())
    assert {r["id"] for r in got} == set(range(n))


def test_epochs_differ(spark):
    first, second = (
        {r["id"]: r["shard"] for r in windows.epoch_shards(spark.range(64), "id", e, 4).collect()} for e in (0, 1)
    )
    assert first != second


def reference_sweeps(grid, sweeps):
    for _ in range(sweeps):
        new = [row[:] for row in grid]
        for i in range(1, len(grid) - 1):
            for j in range(1, len(grid[0]) - 1):
                new[i][j] = 0.25 * (grid[i - 1][j] + grid[i + 1][j] + grid[i][j - 1] + grid[i][j + 1])
        grid = new
    return grid


@pytest.mark.parametrize("tile", [64, 3, 1])
def test_focal_mean_many_sweeps(spark, tile):
    grid = [[float((i * 31 + j * 17) % 100) for j in range(9)] for i in range(7)]
    cells = spark.createDataFrame(
        [(i, j, v, i in (0, 6) or j in (0, 8)) for i, row in enumerate(grid) for j, v in enumerate(row)],
        "i INT, j INT, v DOUBLE, is_border BOOLEAN",
    )
    got = windows.focal_mean(cells, sweeps=5, checkpoint_every=2, tile=tile)
    want = reference_sweeps(grid, 5)
    assert got.count() == 63
    assert all(abs(r["v"] - want[r["i"]][r["j"]]) < 1e-9 for r in got.collect())


@pytest.mark.parametrize("per_exchange", [1, 2, 3, 7])
def test_sweeps_that_share_an_exchange_are_the_same_sweeps(spark, per_exchange):
    """Also with absent cells, null values and cells beyond one tile."""
    cells = [
        (i - 4, j, None if (i, j) == (5, 5) else float((i * 31 + j * 17) % 100), i in (0, 9) or j in (0, 7) or (i, j) == (3, 3))
        for i in range(10) for j in range(8) if (i, j) not in ((2, 4), (9, 7))
    ]
    frame = spark.createDataFrame(cells, "i INT, j INT, v DOUBLE, is_border BOOLEAN").repartition(3)
    one = {(r["i"], r["j"]): r["v"] for r in windows.focal_mean(frame, 5, tile=3, per_exchange=1).collect()}
    got = windows.focal_mean(frame, 5, tile=3, per_exchange=per_exchange).collect()
    assert len(got) == len(cells) == len(one)
    assert all(r["v"] == pytest.approx(one[r["i"], r["j"]]) for r in got)


def test_scaling_table(spark):
    runs = spark.createDataFrame([("a", 1, 8.0), ("a", 2, 4.0), ("a", 4, 4.0)], "c STRING, p INT, t DOUBLE")
    got = windows.scaling_table(runs, "c", "p", "t").orderBy("p").collect()
    assert [(r["speedup"], r["efficiency"]) for r in got] == [(1.0, 1.0), (2.0, 1.0), (2.0, 0.5)]


def test_top_per_group_ties(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 1.0, 1), ("a", 0.5, 3), ("b", 1.0, 9)], "g STRING, v DOUBLE, id INT")
    got = ordering.top_per_group(df, ["g"], ["v", "id"], 2).collect()
    assert {(r["g"], r["rank"], r["id"]) for r in got} == {("a", 1, 3), ("a", 2, 1), ("b", 1, 9)}


def test_union_keeps_copies(spark):
    one = spark.range(3)
    assert ordering.union_frames([one, one, one]).count() == 9


def test_hash_chunks_rise_with_the_hash(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h")).withColumn("c", positions.hash_chunks(F.col("h"), 16))
    got = df.orderBy("h").collect()
    chunks = [r["c"] for r in got]
    assert chunks == sorted(chunks) and set(chunks) == set(range(16))
