"""Queries for projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.catalog.registry import query
from terrella.functions import vectors
from terrella.operators import columns as ops
from terrella.plans.rainfall import CITIES
from terrella.plans.trips import TRIP_ALIASES, TRIP_COLUMNS, TRIP_RULES
from terrella.plans.views import with_views

_TRIP_KEYS = ["l_orderkey", "l_linenumber"]
_TRIPS_SQL = with_views("trips")


@query("rename_normalize", _TRIPS_SQL + " SELECT * FROM trips")
def rename_normalize(t):
    # Spell the columns as another file version does.
    names = {common: old for old, common in TRIP_ALIASES.items()}
    shouted = t.trips.toDF(*[f" {names.get(c, c).upper()}  " for c in t.trips.columns])
    return ops.normalize_names(shouted, TRIP_ALIASES)


@query("select_allowlist", _TRIPS_SQL + f" SELECT {', '.join(TRIP_COLUMNS)} FROM trips")
def select_allowlist(t):
    return ops.keep_columns(t.trips, [*TRIP_COLUMNS, "not_there"])


@query("drop_by_type", "SELECT * EXCLUDE (l_returnflag, l_linestatus) FROM lineitem")
def drop_by_type(t):
    return ops.drop_types(t.lineitem, T.StringType)


@query(
    "downcast_numeric",
    """SELECT l_orderkey::INT AS l_orderkey, l_partkey::INT AS l_partkey, l_suppkey::INT AS l_suppkey,
       l_linenumber, l_quantity::FLOAT AS l_quantity, l_extendedprice::FLOAT AS l_extendedprice,
       l_discount::FLOAT AS l_discount, l_tax::FLOAT AS l_tax, l_returnflag, l_linestatus, l_shipdate
       FROM lineitem""",
)
def downcast_numeric(t):
    return ops.downcast_numeric(t.lineitem)


@query(
    "cast_types",
    """SELECT event_id, CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value,
       CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts, CAST(user_id AS DOUBLE) AS user_id FROM events""",
)
def cast_types(t):
    as_text = t.events.select("event_id", *[F.col(c).cast("string").alias(c) for c in ("value", "ts", "user_id")])
    return ops.cast_columns(as_text, {"value": "double", "ts": "timestamp_ntz", "user_id": "double"})


@query(
    "fill_sentinel",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN TIMESTAMP '1969-12-31 23:59:59.999' ELSE ts END AS ts,
       CASE WHEN user_id % 10 = 0 THEN -1 ELSE user_id END AS user_id,
       CASE WHEN event_type IN ('error', 'view') THEN -1e0 ELSE value END AS value FROM events""",
)
def fill_sentinel(t):
    kind = F.col("event_type")
    holes = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"),
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"),
        F.when(kind == "view", F.lit(float("nan"))).when(kind != "error", F.col("value")).alias("value"),
    )
    return ops.fill_sentinel(holes)


@query("filter_outliers", _TRIPS_SQL + " SELECT * FROM trips WHERE " + " AND ".join(f"({r})" for r in TRIP_RULES))
def filter_outliers(t):
    return ops.filter_all(t.trips, TRIP_RULES)


@query("filter_equals", with_views("obs") + " SELECT * FROM obs WHERE type = 'PRCP'")
def filter_equals(t):
    return t.obs.filter(F.col("type") == "PRCP")


@query(
    "convert_units",
    with_views("obs")
    + " SELECT station_id, obs_ts, round(val * 1 / 10e0 * 0.0393701e0, 9) AS inches FROM obs WHERE type = 'PRCP'",
)
def convert_units(t):
    inches = F.round(ops.tenths_mm_to_inches(F.col("val")), 9)
    return t.obs.filter(F.col("type") == "PRCP").select("station_id", "obs_ts", inches.alias("inches"))


@query(
    "literal_columns",
    with_views("stations")
    + """ SELECT *, 33.7490e0 AS atlanta_lat, -84.3880e0 AS atlanta_lng,
       47.6219e0 AS seattle_lat, -122.3517e0 AS seattle_lng FROM stations""",
)
def literal_columns(t):
    (a_lng, a_lat), (s_lng, s_lat) = CITIES["Atlanta"], CITIES["Seattle"]
    return ops.with_literals(t.stations, atlanta_lat=a_lat, atlanta_lng=a_lng, seattle_lat=s_lat, seattle_lng=s_lng)


@query(
    "split_features_label",
    """SELECT l_discount AS f0, l_extendedprice AS f1, l_linenumber AS f2, l_orderkey AS f3, l_partkey AS f4,
       l_suppkey AS f5, l_tax AS f6, l_quantity AS label FROM lineitem""",
)
def split_features_label(t):
    numbers = ops.drop_types(t.lineitem, T.StringType, T.TimestampNTZType)
    names = ops.feature_names(numbers, "l_quantity")
    return numbers.select(*[F.col(n).alias(f"f{i}") for i, n in enumerate(names)], F.col("l_quantity").alias("label"))


@query(
    "elementwise_chain",
    """SELECT l_orderkey, 2 * l_quantity AS a, round(l_tax + 1, 9) AS b,
       round(2 * l_quantity + (l_tax + 1), 9) AS c, round(2 * (2 * l_quantity + (l_tax + 1) + 5), 9) AS d
       FROM lineitem""",
)
def elementwise_chain(t):
    start = t.lineitem.select("l_orderkey", F.col("l_quantity").alias("a"), F.col("l_tax").alias("b"))
    steps = [("a", "2 * a"), ("b", "b + 1"), ("c", "a + b"), ("d", "c + 5"), ("d", "2 * d")]
    done = ops.elementwise_chain(start, steps)
    return done.select("l_orderkey", "a", *[F.round(c, 9).alias(c) for c in "bcd"])


_EMBEDDING_ROWS = """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x,
  CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos FROM embeddings) """


def _long(df, column):
    return df.select("vec_id", F.posexplode(column).alias("pos", "value")).select(
        "vec_id", "pos", F.round("value", 9).alias("value")
    )


@query(
    "scale_features",
    _EMBEDDING_ROWS + "SELECT vec_id, pos, round(x * (pos % 4 + 1) * 25e-2, 9) AS value FROM e",
)
def scale_features(t):
    factors = [(j % 4 + 1) * 0.25 for j in range(64)]
    return _long(t.embeddings, vectors.scale_by(F.col("embedding"), factors))


@query(
    "normalize_vector",
    _EMBEDDING_ROWS + "SELECT vec_id, pos, round((x - 5e-1) / 25e-2, 9) AS value FROM e",
)
def normalize_vector(t):
    return _long(t.embeddings, vectors.normalize(F.col("embedding"), 0.5, 0.25))


_CHANNEL_MEANS, _CHANNEL_STDS = (0.5, 0.25, 0.75, 1.0), (0.25, 0.5, 2.0, 1.0)


@query(
    "normalize_channels_flatten",
    _EMBEDDING_ROWS
    + f"""SELECT vec_id, pos, round((x - list_extract({[*_CHANNEL_MEANS]}::DOUBLE[], pos // 16 + 1))
         / list_extract({[*_CHANNEL_STDS]}::DOUBLE[], pos // 16 + 1), 9) AS value FROM e""",
)
def normalize_channels_flatten(t):
    """Four channels of 16 components, each with its own mean and deviation, flattened again."""
    channels = vectors.channels_of(F.col("embedding"), 16)
    return _long(t.embeddings, F.flatten(vectors.normalize_channels(channels, _CHANNEL_MEANS, _CHANNEL_STDS)))


PROBES = {
    "negative_time": "dropoff_datetime <= pickup_datetime",
    "short_but_dear": "trip_distance < 10 and fare_amount > 300",
    "long_but_cheap": "trip_distance > 50 and fare_amount < 50",
}


@query(
    "probe_outliers",
    _TRIPS_SQL + " SELECT " + ", ".join(f"count(*) FILTER ({rule}) AS {n}" for n, rule in PROBES.items()) + " FROM trips",
)
def probe_outliers(t):
    return ops.count_matches(t.trips, PROBES)


_PREVIEW_ORDER = [*_TRIP_KEYS, "trip_distance", "fare_amount", "dropoff_datetime"]


@query(
    "preview_outliers",
    _TRIPS_SQL
    + " UNION ALL ".join(
        f" (SELECT '{n}' AS rule, {', '.join(_PREVIEW_ORDER)} FROM trips WHERE {rule}"
        f" ORDER BY {', '.join(_PREVIEW_ORDER)} LIMIT 5)"
        for n, rule in PROBES.items()
    ),
)
def preview_outliers(t):
    previews = [
        ops.preview_matches(t.trips, rule, _PREVIEW_ORDER).select(F.lit(n).alias("rule"), *_PREVIEW_ORDER)
        for n, rule in PROBES.items()
    ]
    return previews[0].unionByName(previews[1]).unionByName(previews[2])


@query(
    "array_to_columns",
    f"SELECT vec_id, label, {', '.join(f'embedding[{i + 1}] AS x{i}' for i in range(64))} FROM embeddings",
)
def array_to_columns(t):
    return ops.array_to_columns(t.embeddings, "embedding", [f"x{i}" for i in range(64)])
