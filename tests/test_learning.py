import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from terrella import catalog
from terrella.learning import models
from terrella.learning.early_stop import early_stop_round
from terrella.learning.linear import gradient_step, gradient_step_vector
from terrella.learning.splits import split_by, split_seeded
from terrella.operators.aggregates import covariance_matrix
from terrella.operators.metrics import inertia
from terrella.operators.partitions import partition_count, pin
from terrella.sources import generators

QUERIES = catalog.queries()


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(10_000)
    train, test = split_seeded(df, ["id"], 0.25, seed=3)
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not a & b and a | b == set(range(10_000))
    assert 0.23 < len(b) / 10_000 < 0.27
    again = {r["id"] for r in split_seeded(df.repartition(7), ["id"], 0.25, seed=3)[1].collect()}
    assert again == b


def test_null_condition_is_train(spark):
    df = spark.createDataFrame([(1,), (None,)], "x INT")
    train, test = split_by(df, F.col("x") == 1)
    assert train.count() == test.count() == 1


def test_regression_recovers_the_coefficients(spark):
    truth = generators.regression_coefficients(8, 3, seed=10)
    assert sum(c != 0 for c in truth) == 3
    rows = generators.regression(spark.range(2000), truth, bias=1.0, noise=0.0, seed=10)
    model = models.fit_line(models.vectors(rows, "features"), "y")
    assert np.allclose(model.coefficients.toArray(), truth, atol=1e-6)
    assert model.intercept == pytest.approx(1.0, abs=1e-6)


def test_key_value_moments(spark):
    row = generators.key_value(spark.range(40_000), 43210).agg(
        F.avg("key").alias("k"), F.avg("value").alias("m"), F.stddev("value").alias("s"), F.kurtosis("value").alias("q")
    ).first()
    assert abs(row["k"] - 0.5) < 0.01 and abs(row["m"]) < 0.02 and abs(row["s"] - 1) < 0.02 and abs(row["q"]) < 0.1


def test_blob_means(spark):
    centers = generators.blob_centers(4, 3, seed=170)
    rows = generators.blobs(spark.range(8000), centers, 0.4, seed=170)
    got = rows.groupBy("label").agg(
        F.count("*").alias("n"), *[F.avg(F.get("features", F.lit(j))).alias(f"x{j}") for j in range(3)]
    ).collect()
    assert len(got) == 4
    for r in got:
        bound = 5 * 0.4 / r["n"] ** 0.5
        assert all(abs(r[f"x{j}"] - centers[r["label"]][j]) < bound for j in range(3))


def test_kmeans_finds_blob_centers(spark):
    centers = [[-10.0, 0.0], [10.0, 0.0], [0.0, 15.0]]
    rows = models.vectors(generators.blobs(spark.range(3000), centers, 0.4, seed=1), "features", "vec")
    model = models.fit_kmeans(rows, 3, features="vec")
    found = sorted(map(tuple, model.clusterCenters()))
    assert np.allclose(found, sorted(map(tuple, centers)), atol=0.1)
    total = inertia(rows, "features", models.center_table(rows, model)).first()["inertia"]
    assert total == pytest.approx(model.summary.trainingCost, rel=1e-6)
    # Each center is the mean of its members.
    members = model.transform(rows).groupBy("prediction").agg(F.avg(F.get("features", F.lit(0))).alias("x"))
    for r in members.collect():
        assert r["x"] == pytest.approx(model.clusterCenters()[r["prediction"]][0], abs=1e-3)


def test_saved_model_has_the_same_centers(spark, tmp_path):
    rows = models.vectors(generators.blobs(spark.range(300), [[0.0, 0.0], [9.0, 9.0]], 0.4, seed=1), "features", "vec")
    model = models.fit_kmeans(rows, 2, features="vec")
    loaded = models.save_and_reload(model, str(tmp_path / "model"))
    assert np.array_equal(model.clusterCenters(), loaded.clusterCenters())


def test_pca_variances_are_the_top_eigenvalues(spark):
    rows = generators.blobs(spark.range(3000), [[5.0, -3.0, 1.0, 0.0]], 1.0, seed=10)
    stretched = rows.withColumn("features", F.transform("features", lambda x, i: x * (4 - i)))
    wide = stretched.select(*[F.get("features", F.lit(j)).alias(f"x{j}") for j in range(4)])
    cov = np.zeros((4, 4))
    for r in covariance_matrix(wide, wide.columns).collect():
        cov[r["row"], r["col"]] = r["cov"]
    top = np.sort(np.linalg.eigvalsh(cov))[::-1][:2]
    projected, model = models.fit_transform_pca(models.vectors(stretched, "features", "vec"), 2, "vec")
    got = projected.agg(
        *[F.var_samp(F.get("components", F.lit(j))).alias(f"v{j}") for j in range(2)],
        *[F.avg(F.get("components", F.lit(j))).alias(f"m{j}") for j in range(2)],
    ).first()
    assert np.allclose([got["v0"], got["v1"]], top, rtol=1e-6)
    assert abs(got["m0"]) < 1e-9 and abs(got["m1"]) < 1e-9


def test_forest_beats_the_mean(spark):
    error = {r["model"]: r["rmse"] for r in QUERIES["rf_fit_predict"](spark, DATA).collect()}
    assert error["forest"] < error["mean"]


def test_boosted_margins(spark):
    got = QUERIES["gbt_margin_predict"](spark, DATA).collect()
    assert all(r["label_1"] == r["prediction"] for r in got)
    assert all(abs(r["probability_1"] - 1 / (1 + np.exp(-r["margin"]))) < 1e-9 for r in got)


def test_boosted_beats_the_majority_class(spark):
    got = QUERIES["gbt_fit_predict"](spark, DATA).collect()
    right = sum(r["y"] == r["label_1"] for r in got)
    ones = sum(r["y"] for r in got)
    assert right >= max(ones, len(got) - ones)


def test_boosting_stops_early(spark):
    """Labels without a pattern: the validation loss stops falling at once."""
    rows = spark.range(400).select(
        (generators.uniform(F.col("id"), 1) < 0.5).cast("int").alias("y"), generators.normal(F.col("id"), 2).alias("x")
    )
    table = pin(models.labelled_features(rows, "y"))
    model, history = models.fit_boosted(table, table.limit(60), "y", max_rounds=64, first_rounds=4, patience=2, depth=5)
    chosen = early_stop_round(history, ["run"], 2).first()
    assert model.getNumTrees == chosen["best_round"] <= 64


def test_boosting_measures_every_round_as_the_cut_model_does(spark):
    rows = spark.range(600).select(
        (generators.normal(F.col("id"), 3) > 0).cast("int").alias("y"),
        (generators.normal(F.col("id"), 3) + generators.normal(F.col("id"), 4)).alias("x"),
    )
    table = pin(models.labelled_features(rows, "y"))
    model = models._boosted("y", "features", 6, 3, 7).fit(table)
    errors = models.error_by_round(model, table, "y")
    assert len(errors) == 6
    for i, error in enumerate(errors):
        cut = models.predict_margin(models.first_rounds_of(model, i + 1), table)
        assert error == pytest.approx(cut.agg(F.avg((F.col("label_1") != F.col("y")).cast("int"))).first()[0])
    with pytest.raises(ValueError):
        models.error_by_round(model, table.limit(0), "y")


def test_boosting_on_loss(spark):
    rows = spark.range(300).select((F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 3 + 0.0).alias("x"))
    table = pin(models.labelled_features(rows, "y"))
    model, history = models.fit_boosted(table, table, "y", max_rounds=3, metric="loss")
    assert model.getNumTrees == history.count() == 3


def test_classifier_report_leaves_nothing_in_memory(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    quality = {r["metric"]: r["value"] for r in QUERIES["classifier_report"](spark, DATA).collect()}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert quality["accuracy"] > 0.5 and 0.5 < quality["roc_auc"] <= 1


def test_perceptron_beats_guessing(spark):
    got = QUERIES["mlp_fit_predict"](spark, DATA).collect()
    assert sum(r["label"] == r["prediction"] for r in got) / len(got) > 0.1


@pytest.mark.parametrize(
    "curve, patience, best, last, stopped",
    [
        ([5, 4, 3, 3, 3, 1], 2, 3, 5, True),
        ([5, 4, 3, 3, 1, 2], 3, 5, 6, False),
        ([1, 2, 3], 10, 1, 3, False),
        ([1] + [2] * 10 + [0], 10, 1, 11, True),
    ],
)
def test_early_stop(spark, curve, patience, best, last, stopped):
    rows = [(0, i + 1, float(m)) for i, m in enumerate(curve)]
    history = spark.createDataFrame(rows, "run INT, round INT, metric DOUBLE").repartition(3)
    got = early_stop_round(history, ["run"], patience).first()
    assert (got["best_round"], got["last_round"], got["stopped"]) == (best, last, stopped)


def test_gradient_steps_reach_the_line(spark):
    line = pin(spark.range(11).select((F.col("id") / 10.0).alias("x"), (F.col("id") / 10.0 * 2 + 1).alias("y")))
    w = b = 0.0
    for _ in range(60):
        step = gradient_step(line, "x", "y", w, b, rate=0.7).first()
        w, b = step["w"], step["b"]
    assert (w, b) == (pytest.approx(2.0, abs=0.05), pytest.approx(1.0, abs=0.05))


def test_partition_count():
    assert partition_count(20_000_000, 1_000_000, 8) == 20
    assert partition_count(10, 1_000_000, 8) == 8


def test_vector_gradient_steps_reach_the_plane(spark):
    rows = spark.range(200).select(
        F.array((F.col("id") % 7 / 7), (F.col("id") % 11 / 11)).alias("f")
    ).withColumn("y", 2 * F.col("f")[0] - F.col("f")[1] + 0.5)
    weights = [0.0, 0.0, 0.0]
    for _ in range(8):
        step = {r["pos"]: r for r in gradient_step_vector(rows, "f", "y", weights[:2], weights[2], 0.5).collect()}
        before, weights = weights, [step[p]["weight"] for p in range(3)]
        for p in range(3):
            assert weights[p] == pytest.approx(before[p] - 0.5 * step[p]["gradient"])
    assert abs(weights[0] - 2) < 1 and abs(weights[1] + 1) < 1.3
