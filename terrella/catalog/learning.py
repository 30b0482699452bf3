"""Queries for splits, models and gradient steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from terrella.catalog.registry import drawn_bits_sql, query
from terrella.functions.numeric import round_half_even, sigmoid
from terrella.functions.vectors import argmax, softmax
from terrella.learning import boosting, factors, models, network
from terrella.learning.early_stop import early_stop_round
from terrella.learning.linear import gradient_step as step
from terrella.learning.linear import gradient_step_vector, predict_line
from terrella.learning.splits import in_test_set, split_by, split_exact, split_seeded
from terrella.operators.columns import array_to_columns, assemble
from terrella.operators.metrics import regression_error
from terrella.operators.partitions import pin
from terrella.plans.trips import trip_features
from terrella.plans.views import with_views
from terrella.sources import generators

_ITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query(
    "split_random",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN
         {drawn_bits_sql(13, "l_orderkey", "l_linenumber", "l_partkey", 1)} % 1000000 < 250000
         THEN 'test' ELSE 'train' END AS part FROM lineitem""",
)
def split_random(t):
    items = t.lineitem.select(*_ITEM_KEYS)
    train, test = split_seeded(items, _ITEM_KEYS, test_share=0.25, seed=1)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "split_seeded",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN (l_orderkey * 7919 + 42) % 100 < 33 THEN 'test' ELSE 'train' END AS part FROM lineitem""",
)
def split_seeded_query(t):
    train, test = split_by(t.lineitem.select(*_ITEM_KEYS), (F.col("l_orderkey") * 7919 + 42) % 100 < 33)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "split_exact",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN row_number() OVER (ORDER BY {drawn_bits_sql(15, "l_orderkey", "l_linenumber", "l_partkey", 3)}, l_orderkey, l_linenumber, l_partkey)
           <= (SELECT round_even(count(*) * 25e-2, 0) FROM lineitem) THEN 'test' ELSE 'train' END AS part FROM lineitem""",
)
def split_exact_query(t):
    """Exactly a quarter of the line items, shuffled."""
    train, test = split_exact(t.lineitem.select(*_ITEM_KEYS), _ITEM_KEYS, test_share=0.25, seed=3)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _coefficients(t, model, names):
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients)] + [("intercept", float(model.intercept))]
    return t.spark.createDataFrame(rows, "name string, value double")


@query(
    "linear_regression",
    """SELECT 'l_quantity' AS name, round(regr_slope(l_extendedprice, l_quantity), 4) AS value FROM lineitem
       UNION ALL SELECT 'intercept', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem""",
)
def linear_regression(t):
    rows = assemble(t.lineitem, ["l_quantity"]).select("features", F.col("l_extendedprice").alias("y"))
    fitted = _coefficients(t, models.fit_line(rows, "y"), ["l_quantity"])
    return fitted.withColumn("value", F.round("value", 4))


_TRUTH = [
    *((f"x{j}", c) for j, c in enumerate(generators.regression_coefficients(16, 5, seed=10))),
    ("intercept", 1.0),
]


@query(
    "linear_regression_recovery",
    f"SELECT name, round(value, 4) AS value FROM (VALUES {', '.join(f'({n!r}, {c!r}::DOUBLE)' for n, c in _TRUTH)}) v(name, value)",
)
def linear_regression_recovery(t):
    """Coefficients fitted to a noise-free table over all event ids; the SQL states the true ones."""
    names, truth = zip(*_TRUTH)
    ids = t.events.select(F.col("event_id").alias("id"))
    made = generators.regression(ids, truth[:-1], bias=truth[-1], noise=0.0, seed=10)
    fitted = _coefficients(t, models.fit_line(models.vectors(made, "features"), "y"), names)
    # Adding zero turns -0.0 into 0.0.
    return fitted.withColumn("value", F.round("value", 4) + 0.0)


_NEARLY = (("x0", 2.0), ("x1", -3.0), ("intercept", 1.0))


@query(
    "linear_regression_qr",
    f"SELECT name, value FROM (VALUES {', '.join(f'({n!r}, {c!r}::DOUBLE)' for n, c in _NEARLY)}) v(name, value)",
)
def linear_regression_qr(t):
    """Coefficients of two features that differ in the seventh digit only; the SQL states the true ones."""
    x = generators.uniform(F.col("event_id"), 41)
    near = x + 1e-7 * generators.uniform(F.col("event_id"), 42)
    rows = t.events.select(F.array(x, near).alias("f"), (2.0 * x - 3.0 * near + 1.0).alias("y"))
    line = factors.least_squares(rows, "f", "y")
    found = [*zip(("x0", "x1"), map(float, line.coefficients)), ("intercept", line.intercept)]
    return t.spark.createDataFrame(found, "name string, value double").withColumn("value", F.round("value", 4))


@query(
    "pca_power",
    """WITH c AS (SELECT var_samp(embedding[1]::DOUBLE) AS a, covar_samp(embedding[1]::DOUBLE, embedding[2]::DOUBLE) AS b,
         var_samp(embedding[2]::DOUBLE) AS c FROM embeddings),
       l AS (SELECT a, b, unnest([0, 1]) AS component, unnest([(a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b),
         (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b)]) AS variance FROM c)
       SELECT component, round(variance, 6) AS variance, round(abs(b) / sqrt(b * b + (variance - a) * (variance - a)), 4) AS x,
         round(abs(variance - a) / sqrt(b * b + (variance - a) * (variance - a)), 4) AS y FROM l""",
)
def pca_power(t):
    """Components of the first two embedding columns, by power iteration; the SQL solves them in closed form."""
    rows = t.embeddings.select(F.slice("embedding", 1, 2).alias("f"))
    found = factors.principal_components(rows, "f", k=2)
    told = [(i, float(v), *map(float, np.abs(a))) for i, (v, a) in enumerate(zip(found.variances, found.axes))]
    frame = t.spark.createDataFrame(told, "component int, variance double, x double, y double")
    return frame.select("component", F.round("variance", 6).alias("variance"), F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query(
    "kmeans_blobs",
    """SELECT n, round(x, 4) AS x, round(y, 4) AS y FROM (
         SELECT count(*) AS n, avg(user_id % 4 * 100 + value / 1e2) AS x, avg(user_id % 4 % 2 * 100 + hour(ts) / 1e1) AS y
         FROM events GROUP BY user_id % 4) c""",
)
def kmeans_blobs(t):
    """Centers of four blobs far apart; the SQL takes the mean of each blob."""
    blob = F.col("user_id") % 4
    x, y = blob * 100 + F.col("value") / 1e2, blob % 2 * 100 + F.hour("ts") / 1e1
    rows = models.vectors(t.events.select(F.array(x, y).alias("p")), "p")
    model = models.fit_kmeans(rows, k=4)
    members = model.transform(rows).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))
    centers = models.center_table(t.events, model).join(members, "cluster")
    return centers.select("n", *[F.round(F.get("center", F.lit(i)), 4).alias(c) for i, c in enumerate("xy")])


@query("kmeans_fit")
def kmeans_fit(t):
    rows = models.vectors(t.embeddings, "embedding")
    model = models.fit_kmeans(rows, k=10)
    members = model.transform(rows).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))
    centers = models.center_table(t.embeddings, model)
    return centers.join(members, "cluster").select("cluster", "n", F.posexplode("center").alias("pos", "value"))


@query("pca_fit_transform")
def pca_fit_transform(t):
    projected, _ = models.fit_transform_pca(models.vectors(t.embeddings, "embedding"))
    return array_to_columns(projected.select("vec_id", "components"), "components", ["x", "y"])


@query("rf_fit_predict")
def rf_fit_predict(t):
    """Test error of a forest on the trip features, next to the error of the mean fare.

    The fare of the view is a tenth of the label; the rest follows the distance.
    """
    fare = F.col("fare_amount") / 10 + 2.5 * F.col("trip_distance")
    # Trip rows have no key of their own; the split reads every column.
    rows = pin(trip_features(t.trips).withColumn("fare_amount", fare))
    train, test = split_seeded(rows, rows.columns, test_share=0.25, seed=1)
    names = [c for c in rows.columns if c != "fare_amount"]
    model = models.fit_forest(assemble(train, names), "fare_amount")
    scored = model.transform(assemble(test, names)).withColumn(
        "mean_fare", train.agg(F.avg("fare_amount").alias("m")).scalar()
    )
    forest = regression_error(scored, "prediction", "fare_amount").withColumn("model", F.lit("forest"))
    return forest.unionByName(
        regression_error(scored, "mean_fare", "fare_amount").withColumn("model", F.lit("mean"))
    )


def boosted_table(t):
    """Events labelled as dear or cheap, with features that hint at it."""
    value = F.col("value")
    return t.events.select(
        "event_id",
        (value > 40).cast("int").alias("y"),
        (value + 15 * generators.normal(F.col("event_id"), 5)).alias("noisy_value"),
        F.hour("ts").cast("double").alias("hour"),
        (F.col("user_id") % 50).cast("double").alias("user_group"),
    )


def _boosted(t):
    """Held-out events with their margin under the best rounds of one training."""
    rows = boosted_table(t).withColumn("features", F.array("hour", "noisy_value", "user_group"))
    held_out = in_test_set(["event_id"], test_share=0.33, seed=42)
    model, _ = boosting.fit_trees(rows, "features", "y", held_out=held_out)
    scored = rows.filter(held_out).withColumn("margin", model.margin(F.col("features")))
    scored = scored.withColumn("probability_1", sigmoid(F.col("margin")))
    return scored.withColumn("label_1", round_half_even(F.col("probability_1")))


@query("gbt_fit_predict")
def gbt_fit_predict(t):
    return _boosted(t).select("event_id", "y", "probability_1", "label_1")


@query("gbt_margin_predict")
def gbt_margin_predict(t):
    prediction = (F.col("margin") > 0).cast("int").alias("prediction")
    return _boosted(t).select("event_id", "margin", "probability_1", "label_1", prediction)


def cautious(margin, label):
    """Log-loss in which a missed 1 counts twice."""
    gradient, hessian = boosting.logistic(margin, label)
    return gradient * (1 + label), hessian * (1 + label)


def _splits_sql(level: int, nodes: str) -> str:
    """Best split of each node, from rows (event_id, node) of ``nodes``."""
    score = lambda g, h: f"({g}) * ({g}) / (({h}) + 1)"
    gain = f"({score('lg', 'lh')} + {score('ag - lg', 'ah - lh')} - {score('ag', 'ah')}) / 2"
    return f"""s{level} AS (SELECT node, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM codes JOIN {nodes} USING (event_id) GROUP BY ALL),
  t{level} AS (SELECT node, feature, bin, sum(g) OVER w AS lg, sum(h) OVER w AS lh, CAST(sum(n) OVER w AS BIGINT) AS ln,
      sum(g) OVER a AS ag, sum(h) OVER a AS ah, CAST(sum(n) OVER a AS BIGINT) AS an
    FROM s{level} WINDOW w AS (PARTITION BY node, feature ORDER BY bin), a AS (PARTITION BY node, feature)),
  b{level} AS (SELECT DISTINCT ON (node) node, feature, bin, lg, lh, ln, ag, ah, an, {gain} AS gain FROM t{level} WHERE ln < an
    ORDER BY node, round({gain}, 9) DESC, feature, bin),
  n{level} AS (SELECT event_id, 2 * node + CASE WHEN c.bin <= b.bin THEN 1 ELSE 2 END AS node
    FROM {nodes} JOIN b{level} AS b USING (node) JOIN codes AS c USING (event_id, feature))"""


_EIGHTHS = ", ".join(f"{i / 8}" for i in range(1, 8))

_FIRST_TREE = f"""{with_views("scored")},
  rows_ AS (SELECT event_id, (score - y) * (1 + y) AS g, score * (1 - score) * (1 + y) AS h,
      CAST(hour(ts) AS DOUBLE) AS f0, CAST(user_id % 50 AS DOUBLE) AS f1, floor(value / 5) AS f2 FROM scored JOIN events USING (event_id)),
  long AS (SELECT event_id, g, h, unnest([0, 1, 2]) AS feature, unnest([f0, f1, f2]) AS v FROM rows_),
  cuts AS (SELECT feature, list_distinct(quantile_disc(v, [{_EIGHTHS}])) AS q FROM long GROUP BY feature),
  codes AS (SELECT event_id, g, h, feature, 1 + len(list_filter(q, lambda x: x < v)) AS bin FROM long JOIN cuts USING (feature)),
  root AS (SELECT event_id, 0 AS node FROM rows_),
  {_splits_sql(0, "root")}, {_splits_sql(1, "n0")},
  parts AS (SELECT * FROM b0 UNION ALL SELECT * FROM b1),
  inner_ AS (SELECT node, feature, list_sort(q)[bin] AS border, gain, -ag / (ah + 1) AS value, an AS n FROM parts JOIN cuts USING (feature)),
  leaves AS (SELECT 2 * node + 1 AS node, NULL AS feature, NULL AS border, 0e0 AS gain, -lg / (lh + 1) AS value, ln AS n FROM b1
    UNION ALL SELECT 2 * node + 2, NULL, NULL, 0e0, -(ag - lg) / (ah - lh + 1), an - ln FROM b1)
  SELECT CAST(node AS INT) AS node, CAST(feature AS INT) AS feature, border, round(gain, 4) AS gain, round(value, 6) AS value, n AS rows
  FROM (SELECT * FROM inner_ UNION ALL SELECT * FROM leaves)"""


@query("gbt_custom_objective", _FIRST_TREE)
def gbt_custom_objective(t):
    """First tree of an own objective, grown on top of the margins of ``scored``."""
    features = F.array(F.hour("ts").cast("double"), (F.col("user_id") % 50).cast("double"), F.floor(F.col("value") / 5).cast("double"))
    rows = t.scored.join(t.events.select("event_id", features.alias("features")), "event_id")
    model, _ = boosting.fit_trees(rows, "features", "y", cautious, margin="margin", rounds=1, depth=2, bins=8)
    nodes = model.nodes(t.spark).drop("tree", "bin")
    return nodes.withColumn("gain", F.round("gain", 4)).withColumn("value", F.round("value", 6))


_CURVE = """WITH c AS (SELECT event_type AS run, CAST(day(ts) AS INT) AS round, round(avg(value), 6) AS metric
  FROM events GROUP BY 1, 2),
  m AS (SELECT *, min(metric) OVER (PARTITION BY run ORDER BY round) AS low FROM c),
  b AS (SELECT run, round, metric, max(CASE WHEN metric = low AND NOT EXISTS (
      SELECT 1 FROM c p WHERE p.run = m.run AND p.round < m.round AND p.metric <= m.metric) THEN round END)
    OVER (PARTITION BY run ORDER BY round) AS best FROM m),
  s AS (SELECT run, min(round) AS stop FROM b WHERE round - best >= 10 GROUP BY 1)"""


@query(
    "early_stop_round",
    _CURVE
    + """ SELECT b.run, CAST(max(b.best) AS INT) AS best_round, min(b.metric) AS best_metric,
        max(b.round) AS last_round, bool_or(s.stop IS NOT NULL) AS stopped
      FROM b LEFT JOIN s USING (run) WHERE s.stop IS NULL OR b.round <= s.stop GROUP BY b.run""",
)
def early_stop_round_query(t):
    """Stop rule on one curve per event type: the mean value of each day of the month."""
    curve = t.events.groupBy(
        F.col("event_type").alias("run"), F.dayofmonth("ts").cast("int").alias("round")
    ).agg(F.round(F.avg("value"), 6).alias("metric"))
    return early_stop_round(curve, ["run"], 10)


@query(
    "batch_predict",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
         FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_quantity, round(a * l_quantity + b, 4) AS prediction FROM lineitem, f""",
)
def batch_predict(t):
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    slope = t.lineitem.agg(F.regr_slope(y, x).alias("s")).scalar()
    intercept = t.lineitem.agg(F.regr_intercept(y, x).alias("i")).scalar()
    predicted = predict_line(t.lineitem, "l_quantity", slope, intercept)
    return predicted.select("l_orderkey", "l_linenumber", "l_quantity", F.round("prediction", 4).alias("prediction"))


@query("mlp_fit_predict")
def mlp_fit_predict(t):
    """Label and confidence of held-out vectors, by a network trained on the others.

    The label is the place of the largest of the first ten components; that of the table has nothing to do with the vectors.
    """
    label = argmax(F.slice("embedding", 1, 10)).alias("label")
    rows, test = split_seeded(t.embeddings.select("vec_id", "embedding", label), ["vec_id"], test_share=0.25, seed=7)
    start = network.Training(network.Network.drawn([64, 32, 10]), network.Adam(rate=0.01))
    trained = network.train(rows, "embedding", "label", "vec_id", start, epochs=6, batch_rows=max(64, rows.count() // 6), shards=2)
    scored = test.withColumn("_p", softmax(trained.network.logits(F.col("embedding"))))
    return scored.select(
        "vec_id", F.col("label").cast("int"), argmax(F.col("_p")).alias("prediction"), F.array_max("_p").alias("confidence")
    )


#: Weights of a 2-2-2 network: per layer the matrix row by row, then the biases.
_SMALL = (0.5, -0.4, 0.3, 0.2, 0.1, -0.1, 0.6, -0.3, -0.2, 0.4, 0.05, -0.05)
_SMALL_SHARDS, _SMALL_RATE = 4, 0.5


def _step_sql(step: int) -> str:
    """One batch forward, backward, and the weights after it."""
    w = [f"w{i}" for i in range(12)]
    terms = [f"e{j} * x{i}" for i in (0, 1) for j in (0, 1)] + ["e0", "e1"]
    terms += [f"d{j} * a{i}" for i in (0, 1) for j in (0, 1)] + ["d0", "d1"]
    moved = ", ".join(f"any_value(w{i}) - {_SMALL_RATE} * avg({term}) AS w{i}" for i, term in enumerate(terms))
    return f"""h{step} AS (SELECT cut.*, {", ".join(w)}, greatest(x0 * w0 + x1 * w2 + w4, 0e0) AS a0, greatest(x0 * w1 + x1 * w3 + w5, 0e0) AS a1
    FROM cut, u{step} WHERE batch = {step}),
  z{step} AS (SELECT *, a0 * w6 + a1 * w8 + w10 AS z0, a0 * w7 + a1 * w9 + w11 AS z1 FROM h{step}),
  d{step} AS (SELECT *, 1 / (1 + exp(z1 - z0)) - (y = 0)::INT AS d0, 1 / (1 + exp(z0 - z1)) - (y = 1)::INT AS d1,
      ln(exp(z0) + exp(z1)) - CASE y WHEN 0 THEN z0 ELSE z1 END AS loss, (z1 > z0)::INT = y AS hit FROM z{step}),
  e{step} AS (SELECT *, CASE WHEN a0 > 0 THEN d0 * w6 + d1 * w7 ELSE 0e0 END AS e0, CASE WHEN a1 > 0 THEN d0 * w8 + d1 * w9 ELSE 0e0 END AS e1 FROM d{step}),
  u{step + 1} AS (SELECT {moved} FROM e{step})"""


_TWO_STEPS = f"""WITH m AS (SELECT embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS x1, label % 2 AS y,
      row_number() OVER (ORDER BY {drawn_bits_sql(15, "vec_id", 0)}, vec_id) - 1 AS pos, count(*) OVER () AS n FROM embeddings),
  p AS (SELECT *, CAST(ceil(n / {_SMALL_SHARDS}e0) AS BIGINT) AS slots FROM m),
  dealt AS (SELECT *, unnest(range(pos, slots * {_SMALL_SHARDS}, n)) // {_SMALL_SHARDS} AS slot FROM p),
  cut AS (SELECT x0, x1, y, CAST(slot // CAST(ceil(slots / 2e0) AS BIGINT) AS INT) AS batch FROM dealt),
  u0 AS (SELECT {", ".join(f"{w}::DOUBLE AS w{i}" for i, w in enumerate(_SMALL))}),
  {_step_sql(0)}, {_step_sql(1)}"""


def _two_steps(t):
    """One epoch of two batches over all vectors, dealt to four shards."""
    rows = t.embeddings.select("vec_id", F.slice("embedding", 1, 2).alias("x"), (F.col("label") % 2).alias("y"))
    slots = -(-rows.count() // _SMALL_SHARDS)
    start = network.Training(network.Network((2, 2, 2), np.array(_SMALL)), network.Descent(_SMALL_RATE))
    return network.train(rows, "x", "y", "vec_id", start, epochs=1, batch_rows=_SMALL_SHARDS * -(-slots // 2), shards=_SMALL_SHARDS)


@query(
    "train_network",
    _TWO_STEPS
    + """ SELECT CAST(substr(name, 2) AS INT) AS pos, round(value, 6) AS weight FROM (UNPIVOT u2 ON COLUMNS(*) INTO NAME name VALUE value)""",
)
def train_network(t):
    """All weights after two bulk-synchronous steps."""
    found = [(i, float(w)) for i, w in enumerate(_two_steps(t).network.weights)]
    return t.spark.createDataFrame(found, "pos int, weight double").withColumn("weight", F.round("weight", 6))


@query(
    "train_network_loss",
    _TWO_STEPS
    + """ SELECT 0 AS epoch, round(sum(loss), 4) AS loss, count(*) AS rows, round(avg(hit::INT), 6) AS accuracy
      FROM (SELECT loss, hit FROM d0 UNION ALL SELECT loss, hit FROM d1)""",
)
def train_network_loss(t):
    """Loss and accuracy of an epoch, each batch under the weights it met."""
    told = _two_steps(t).losses(t.spark)
    return told.withColumn("loss", F.round("loss", 4)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "gradient_step",
    """WITH g AS (SELECT avg(2 * (5e-1 * l_quantity + 1 - l_extendedprice / 1e3) * l_quantity) AS gw,
         avg(2 * (5e-1 * l_quantity + 1 - l_extendedprice / 1e3)) AS gb FROM lineitem)
       SELECT round(gw, 6) AS grad_w, round(gb, 6) AS grad_b, round(5e-1 - 1e-3 * gw, 6) AS w,
         round(1 - 1e-3 * gb, 6) AS b FROM g""",
)
def gradient_step(t):
    rows = t.lineitem.select("l_quantity", (F.col("l_extendedprice") / 1e3).alias("y"))
    moved = step(rows, "l_quantity", "y", w=0.5, b=1.0, rate=1e-3)
    return moved.select(*[F.round(c, 6).alias(c) for c in moved.columns])


@query(
    "gradient_step_vector",
    """WITH e AS (SELECT vec_id, label, list_transform(list_append(embedding::DOUBLE[], 1e0), lambda x: x) AS f FROM embeddings),
       r AS (SELECT f, list_sum(list_transform(f, lambda x, i: x * CASE WHEN i = 65 THEN 5e-1 ELSE (i - 1) * 1e-2 END)) - label
         AS residual FROM e),
       g AS (SELECT CAST(generate_subscripts(f, 1) - 1 AS INT) AS pos, 2 * residual * unnest(f) AS term FROM r)
       SELECT pos, round(avg(term), 6) + 0e0 AS gradient,
         round(CASE WHEN pos = 64 THEN 5e-1 ELSE pos * 1e-2 END - 1e-1 * avg(term), 6) + 0e0 AS weight FROM g GROUP BY pos""",
)
def gradient_step_over_vector(t):
    rows = t.embeddings.select("embedding", F.col("label").cast("double").alias("y"))
    moved = gradient_step_vector(rows, "embedding", "y", [j * 0.01 for j in range(64)], 0.5, rate=0.1)
    return moved.select("pos", *[(F.round(c, 6) + 0.0).alias(c) for c in ("gradient", "weight")])
