"""Queries for windows, sorts, top-k, unions and partition functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from terrella.catalog.aggregates import FOCAL_SQL
from terrella.catalog.functions import haversine_sql
from terrella.catalog.registry import drawn_bits_sql, query
from terrella.functions import vectors
from terrella.operators import ordering, partitions, windows
from terrella.plans.rainfall import station_year_totals
from terrella.plans.views import with_views
from terrella.plans.views import with_views


@query(
    "balanced_blocks",
    """SELECT o_custkey, o_orderkey,
       CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS owner FROM orders""",
)
def balanced_blocks(t):
    orders = t.orders.select("o_custkey", "o_orderkey")
    return windows.balanced_blocks(orders, ["o_custkey"], ["o_orderkey"], 4)


@query(
    "exclusive_prefix_sum",
    """SELECT o_custkey, n, CAST(sum(n) OVER (ORDER BY o_custkey) - n AS BIGINT) AS "offset"
       FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) c""",
)
def exclusive_prefix_sum(t):
    return windows.block_offsets(t.orders, "o_custkey")


@query(
    "neighbour_shift",
    """SELECT event_id, user_id, value,
       lag(value, 1, 777e0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events""",
)
def neighbour_shift(t):
    events = t.events.select("event_id", "user_id", "ts", "value")
    return windows.neighbour(events, ["user_id"], ["ts", "event_id"], "value", 777.0).drop("ts")


@query(
    "strided_select",
    """WITH e AS (SELECT vec_id, unnest(embedding[1:64:3]) AS value,
         generate_subscripts(embedding[1:64:3], 1) - 1 AS slot FROM embeddings)
       SELECT vec_id, CAST(slot AS INT) AS slot, value FROM e""",
)
def strided_select(t):
    return t.embeddings.select(
        "vec_id", F.posexplode(vectors.every_kth(F.col("embedding"), 3)).alias("slot", "value")
    )


@query(
    "strided_rows",
    """SELECT event_id, user_id FROM (SELECT event_id, user_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events) p WHERE pos % 3 = 0""",
)
def strided_rows(t):
    events = t.events.select("event_id", "user_id", "ts")
    return windows.every_kth_row(events, ["user_id"], ["ts", "event_id"], 3).drop("ts")


_BATCHES = """WITH b AS (SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS n,
  row_number() OVER (PARTITION BY event_type ORDER BY (event_id * 7919 + 13) % 1000003, event_id) - 1 AS pos
  FROM events) SELECT event_id, event_type, pos // 64 AS batch FROM b"""


def _batches(t, drop_last):
    events = t.events.select(
        "event_id", "event_type", ((F.col("event_id") * 7919 + 13) % 1000003).alias("mixed")
    )
    return windows.assign_batches(events, "event_type", ["mixed", "event_id"], 64, drop_last).drop("mixed")


@query("batch_assign", _BATCHES)
def batch_assign(t):
    return _batches(t, drop_last=False)


@query("batch_assign_drop_last", _BATCHES + " WHERE pos < n - n % 64")
def batch_assign_drop_last(t):
    return _batches(t, drop_last=True)


@query(
    "epoch_shards",
    f"""WITH m AS (SELECT doc_id, row_number() OVER (ORDER BY {drawn_bits_sql(15, "doc_id", 3)}, doc_id) - 1 AS pos,
         count(*) OVER () AS size FROM documents),
       p AS (SELECT doc_id, unnest(range(pos, CAST(ceil(size / 8e0) AS BIGINT) * 8, size)) AS place FROM m)
       SELECT doc_id, CAST(place % 8 AS INT) AS shard, place // 8 AS slot FROM p""",
)
def epoch_shards(t):
    return windows.epoch_shards(t.documents.select("doc_id"), "doc_id", epoch=3, shards=8)


@query(
    "epoch_shard_sizes",
    """SELECT CAST(shard AS INT) AS shard, CAST(ceil(n / 8e0) AS BIGINT) AS n, CAST(ceil(n / 8e0) AS BIGINT) - 1 AS last_slot
       FROM (SELECT count(*) AS n FROM documents) c, range(8) r(shard)""",
)
def epoch_shard_sizes(t):
    dealt = windows.epoch_shards(t.documents.select("doc_id"), "doc_id", epoch=3, shards=8)
    return dealt.groupBy("shard").agg(F.countDistinct("slot").alias("n"), F.max("slot").alias("last_slot"))


@query("focal_mean", FOCAL_SQL + " SELECT i, j, round(v, 6) AS v, is_border FROM swept")
def focal_mean(t):
    return windows.focal_mean(t.cells).withColumn("v", F.round("v", 6))


def _swept_sql(before: str, after: str) -> str:
    sides = " ".join(
        f"LEFT JOIN {before} {n} ON {n}.i = c.i + ({di}) AND {n}.j = c.j + ({dj})"
        for n, di, dj in (("n", -1, 0), ("s", 1, 0), ("w", 0, -1), ("e", 0, 1))
    )
    return f"""{after} AS (SELECT c.i, c.j, c.is_border,
      CASE WHEN c.is_border THEN c.v ELSE 25e-2 * (n.v + s.v + w.v + e.v) END AS v FROM {before} c {sides})"""


@query(
    "focal_mean_sweeps",
    with_views("cells")
    + "".join(", " + _swept_sql(a, b) for a, b in zip(("cells", "c1", "c2", "c3"), ("c1", "c2", "c3", "c4")))
    + " SELECT i, j, round(v, 6) AS v, is_border FROM c4",
)
def focal_mean_sweeps(t):
    """Four sweeps after a single exchange."""
    return windows.focal_mean(t.cells, sweeps=4, per_exchange=4).withColumn("v", F.round("v", 6))


_RUNS = """WITH runs AS (SELECT event_type AS name, CAST(power(2, user_id % 4) AS INT) AS workers,
  sum(value) AS seconds FROM events GROUP BY 1, 2)"""


@query(
    "scaling_table",
    _RUNS
    + """, base AS (SELECT name, arg_min(seconds, workers) AS t1, min(workers) AS p1 FROM runs GROUP BY 1)
      SELECT name, workers, round(seconds, 4) AS seconds, round(t1 / seconds, 6) AS speedup,
        round(t1 / seconds * p1 / workers, 6) AS efficiency FROM runs JOIN base USING (name)""",
)
def scaling_table(t):
    workers = F.pow(F.lit(2), F.col("user_id") % 4).cast("int").alias("workers")
    runs = t.events.groupBy(F.col("event_type").alias("name"), workers).agg(F.sum("value").alias("seconds"))
    table = windows.scaling_table(runs, "name", "workers", "seconds")
    return table.select(
        "name", "workers", F.round("seconds", 4).alias("seconds"), *[F.round(c, 6).alias(c) for c in ("speedup", "efficiency")]
    )


@query("head_n", "SELECT * FROM events ORDER BY event_id LIMIT 10")
def head_n(t):
    return ordering.head(t.events, ["event_id"], 10)


@query(
    "head_per_part",
    """SELECT part, rank, event_id, value FROM (SELECT event_id, value, CAST(event_id % 4 AS INT) AS part,
         CAST(row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS INT) AS rank FROM events) r
       WHERE rank <= 5""",
)
def head_per_part(t):
    parts = t.events.select((F.col("event_id") % 4).cast("int").alias("part"), "event_id", "value")
    return ordering.top_per_group(parts, ["part"], ["event_id"], 5)


@query(
    "sort_by_key",
    with_views("obs")
    + """, y AS (SELECT station_id, CAST(year(obs_ts) AS INT) AS year, sum(val * 1 / 10e0 * 0.0393701e0) AS rain
          FROM obs WHERE type = 'PRCP' GROUP BY 1, 2)
      SELECT station_id, year, round(rain, 6) AS rain,
        CAST(row_number() OVER (PARTITION BY station_id ORDER BY year) AS INT) AS rank FROM y""",
)
def sort_by_key(t):
    totals = station_year_totals(t.obs).withColumn("rain", F.round("rain", 6))
    return ordering.ranked_sort(totals, ["station_id"], ["year"])


_TOP_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


@query(
    "topk_per_group",
    f"""SELECT l_suppkey, l_extendedprice, {', '.join(_TOP_ORDER)}, rank FROM (SELECT *, CAST(row_number() OVER (
         PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, {', '.join(_TOP_ORDER)}) AS INT) AS rank FROM lineitem) r
       WHERE rank <= 5""",
)
def topk_per_group(t):
    items = t.lineitem.select("l_suppkey", "l_extendedprice", *_TOP_ORDER)
    return ordering.top_per_group(items, ["l_suppkey"], [F.desc("l_extendedprice"), *_TOP_ORDER], 5)


@query("union_frames", "SELECT event_id, event_type, value FROM events")
def union_frames(t):
    rows = t.events.select("event_id", "event_type", "value")
    quarter = F.coalesce("event_id", F.lit(0)) % 4
    return ordering.union_frames([rows.filter(quarter == k) for k in range(4)])


def _distance_to_atlanta(batch: pd.DataFrame) -> pd.DataFrame:
    lon, lat = np.radians(batch["longitude"]), np.radians(batch["latitude"])
    city_lon, city_lat = np.radians(-84.3880), np.radians(33.7490)
    chord = np.sin((city_lat - lat) / 2) ** 2 + np.cos(lat) * np.cos(city_lat) * np.sin((city_lon - lon) / 2) ** 2
    return pd.DataFrame({"station_id": batch["station_id"], "km": (2 * 6371 * np.arcsin(np.sqrt(chord))).round(6)})


@query(
    "udf_map_partitions",
    with_views("stations")
    + f""" SELECT station_id, round({haversine_sql("longitude", "latitude", "-84.3880e0", "33.7490e0")}, 6) AS km FROM stations""",
)
def udf_map_partitions(t):
    return partitions.map_partitions(t.stations, _distance_to_atlanta, "station_id long, km double")


def _add_five(x: pd.Series) -> pd.Series:
    return x + 5


@query("udf_scalar_reduce", "SELECT round(sum(value + 5), 4) AS total FROM events")
def udf_scalar_reduce(t):
    return partitions.map_reduce(t.events, "value", _add_five).select(F.round("total", 4).alias("total"))
