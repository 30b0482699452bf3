"""Queries for readers, generators and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrella.catalog.registry import normal_sql, query, uniform_sql
from terrella.learning.models import center_table, fit_kmeans, save_and_reload, vectors
from terrella.operators.columns import array_to_columns, cast_columns
from terrella.plans.views import with_views
from terrella.session import scratch_path
from terrella.sinks import writers
from terrella.sources import datasets, generators, readers


def _ddl(df) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


@query("scan_csv_typed", "SELECT * FROM lineitem")
def scan_csv_typed(t):
    path = scratch_path(t.spark, "csv-typed")
    t.lineitem.write.option("header", True).csv(path)
    return readers.read_csv_typed(t.spark, path, _ddl(t.lineitem))


@query(
    "scan_csv_versions",
    """SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_orderkey % 2 = 0 THEN l_tax END AS l_tax FROM lineitem""",
)
def scan_csv_versions(t):
    """Two versions of a file: other order and names of columns, one column more."""
    path = scratch_path(t.spark, "csv-versions")
    even = F.coalesce(F.col("l_orderkey") % 2 == 0, F.lit(False))
    new = t.lineitem.filter(even).select(F.col("l_tax").alias(" L_Tax"), "l_linenumber", "l_quantity", "l_orderkey", "l_partkey")
    old = t.lineitem.filter(~even).select(F.col("l_quantity").alias("qty"), "l_orderkey", "l_linenumber")
    for rows, folder in ((new, "new"), (old, "old")):
        rows.write.option("header", True).csv(f"{path}/{folder}")
    kept = _ddl(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"))
    return readers.read_csv_typed(t.spark, [f"{path}/new", f"{path}/old"], kept, {"qty": "l_quantity"})


@query("scan_csv_headerless_gz", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_csv_headerless_gz(t):
    path = scratch_path(t.spark, "csv-gz")
    t.orders.write.option("compression", "gzip").csv(path)
    return readers.read_csv_headerless(
        t.spark, path, _ddl(t.orders), t.orders.columns[:4], t.spark.sparkContext.defaultParallelism
    )


@query(
    "scan_csv_positional_names",
    """SELECT p_partkey AS key, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size,
       p_retailprice AS price FROM part""",
)
def scan_csv_positional_names(t):
    path = scratch_path(t.spark, "csv-positional")
    t.part.write.csv(path)
    kinds = [kind for _, kind in t.part.dtypes]
    return readers.read_csv_positional(t.spark, path, kinds, ["key", "name", "brand", "kind", "size", "price"])


@query(
    "scan_fixed_width",
    with_views("stations")
    + """ SELECT CAST(station_id AS VARCHAR) AS station_id, round(latitude, 4) AS latitude,
       round(longitude, 4) AS longitude FROM stations""",
)
def scan_fixed_width(t):
    path = scratch_path(t.spark, "fixed-width")
    line = F.format_string('%-11d %8.4f %9.4f NAME "%d', "station_id", "latitude", "longitude", "station_id")
    t.stations.select(line.alias("value")).write.text(path)
    cut = readers.read_fixed_width(t.spark, path, datasets.STATION_FILE)
    return cast_columns(cut, {"latitude": "double", "longitude": "double"})


def _event_ids(t):
    return t.events.select(F.col("event_id").alias("id"))


def _rounded(df, digits, *names):
    """Logarithms and cosines of two engines differ in their last digits."""
    return df.withColumns({n: F.round(n, digits) + 0.0 for n in names})


@query(
    "gen_key_value",
    f"""SELECT event_id AS id, CAST({uniform_sql("event_id", 43210, 7)} < 5e-1 AS INT) AS key,
       round({normal_sql("event_id", 43210)}, 9) + 0e0 AS value FROM events""",
)
def gen_key_value(t):
    return _rounded(generators.key_value(_event_ids(t), seed=43210), 9, "value")


_CENTERS = generators.blob_centers(8, 6, seed=170)


@query(
    "gen_blobs",
    f"""WITH b AS (SELECT event_id AS id, CAST(floor({uniform_sql("event_id", 170, -1)} * 8) AS INT) AS label FROM events)
       SELECT id, label, """
    + ", ".join(
        f"round(list_extract({[c[j] for c in _CENTERS]}::DOUBLE[], label + 1) + 4e-1 * {normal_sql('id', 170, j)}, 9) + 0e0 AS x{j}"
        for j in range(6)
    )
    + " FROM b",
)
def gen_blobs(t):
    made = generators.blobs(_event_ids(t), _CENTERS, 0.4, seed=170)
    names = [f"x{j}" for j in range(6)]
    return _rounded(array_to_columns(made, "features", names), 9, *names)


_COEFFICIENTS = generators.regression_coefficients(12, 4, seed=10)


@query(
    "gen_regression",
    "WITH x AS (SELECT event_id AS id, "
    + ", ".join(f"{normal_sql('event_id', 10, j)} AS x{j}" for j in range(12))
    + " FROM events) SELECT id, "
    + ", ".join(f"round(x{j}, 9) + 0e0 AS x{j}" for j in range(12))
    + ", round(1e0 + "
    + " + ".join(f"x{j} * CAST({c!r} AS DOUBLE)" for j, c in enumerate(_COEFFICIENTS))
    + ", 6) + 0e0 AS y FROM x",
)
def gen_regression(t):
    made = generators.regression(_event_ids(t), _COEFFICIENTS, bias=1.0, noise=0.0, seed=10)
    names = [f"x{j}" for j in range(12)]
    return _rounded(_rounded(array_to_columns(made, "features", names), 9, *names), 6, "y")


@query(
    "gen_noisy_line",
    """SELECT event_id AS id, round(event_id * 10e0 / (n - 1), 9) AS x,
       round(2e0 * (event_id * 10e0 / (n - 1)) + 1e0, 9) AS y
       FROM events, (SELECT count(*) AS n FROM events) AS c""",
)
def gen_noisy_line(t):
    ids = _event_ids(t)
    count = ids.agg(F.count("*").alias("n")).scalar()
    line = generators.noisy_line(ids, count, noise=0.0)
    return line.select("id", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query(
    "gen_merge_pair",
    """WITH r AS (SELECT CASE WHEN o_orderkey * 7919 % 10 < 3 THEN o_orderkey
                    ELSE o_orderkey + 1 + (SELECT max(o_orderkey) FROM orders) END AS key,
                  o_orderkey * 3 AS value FROM orders)
       SELECT 'left' AS side, o_orderkey AS key, o_orderkey * 2 AS value FROM orders
       UNION ALL SELECT 'right' AS side, key, value FROM r""",
)
def gen_merge_pair(t):
    left, right = merge_tables(t)
    return left.select(F.lit("left").alias("side"), "key", F.col("left_value").alias("value")).unionByName(
        right.select(F.lit("right").alias("side"), "key", F.col("right_value").alias("value"))
    )


def merge_tables(t):
    """The two join-test tables over all order keys, 30 percent of them matching."""
    ids = t.orders.select(F.col("o_orderkey").alias("id"))
    shift = ids.agg((F.max("id") + 1).alias("s")).scalar()
    return generators.merge_pair(ids, F.col("id") * 7919 % 10 < 3, shift)


@query("sink_csv_head", with_views("stations") + " SELECT * FROM stations ORDER BY station_id LIMIT 20")
def sink_csv_head(t):
    path = scratch_path(t.spark, "csv-head")
    writers.write_head(t.stations, path, ["station_id"])
    return readers.read_csv_typed(t.spark, path, _ddl(t.stations))


@query("model_save_load")
def model_save_load(t):
    model = fit_kmeans(vectors(t.embeddings, "embedding"), k=10)
    loaded = save_and_reload(model, scratch_path(t.spark, "kmeans"))
    return center_table(t.embeddings, loaded).select(
        "cluster", F.posexplode("center").alias("pos", "value")
    )


@query(
    "sink_append_runs",
    """SELECT CAST(user_id % 8 + 1 AS INT) AS workers, round(avg(value), 4) AS seconds
       FROM events GROUP BY event_type, 1""",
)
def sink_append_runs(t):
    path = scratch_path(t.spark, "runs")
    # One run is appended per event type found.
    for (kind,) in t.events.select("event_type").distinct().orderBy("event_type").collect():
        workers = (F.col("user_id") % 8 + 1).cast("int").alias("workers")
        runs = t.events.filter(F.col("event_type").eqNullSafe(F.lit(kind))).groupBy(workers)
        writers.append_runs(runs.agg(F.round(F.avg("value"), 4).alias("seconds")), path)
    return t.spark.read.schema("workers INT, seconds DOUBLE").option("sep", " ").csv(path)


@query(
    "sink_grid_long",
    with_views("cells") + " SELECT round(j * 1e-1, 6) AS x, round(i * -1e-1 + 0e0, 6) AS y, v AS value FROM cells",
)
def sink_grid_long(t):
    path = scratch_path(t.spark, "grid")
    writers.write_grid(t.cells, path)
    rows = t.spark.read.schema("x DOUBLE, y DOUBLE, value DOUBLE").option("sep", "\t").csv(path)
    return rows.select(F.round("x", 6).alias("x"), F.round(F.col("y") + 0.0, 6).alias("y"), "value")
