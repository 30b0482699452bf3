"""Thin recipes over Spark ML estimators, with vectors kept at the boundary."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.functions.numeric import round_half_even, sigmoid
from terrella.learning.early_stop import early_stop_round
from terrella.operators.columns import assemble, feature_names
from terrella.session import ensure_checkpoint_dir


def vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    """Turn an array column into the vector column the estimators read."""
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def labelled_features(df: DataFrame, label: str) -> DataFrame:
    """All columns but the label, in name order, as one vector next to the label."""
    return assemble(df, feature_names(df, label))


def fit_line(df: DataFrame, label: str, features: str = "features") -> LinearRegressionModel:
    """Least squares with intercept on unscaled features.

    The normal equations take one pass and suit up to 4096 features.
    """
    return LinearRegression(
        featuresCol=features, labelCol=label, fitIntercept=True, standardization=False, solver="normal"
    ).fit(df)


def fit_kmeans(df: DataFrame, k: int, seed: int = 1, features: str = "features", max_iter: int = 100) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter, tol=1e-6).fit(df)


def center_table(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Centers of a fitted clustering as rows (cluster, center)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, center array<double>")


def save_and_reload(model: KMeansModel, path: str) -> KMeansModel:
    model.write().overwrite().save(path)
    return KMeansModel.load(path)


def fit_transform_pca(df: DataFrame, k: int = 2, features: str = "features") -> tuple[DataFrame, PCAModel]:
    """Project centered, unscaled features on the first k components.

    Spark's PCA does not center when it transforms, so a scaler does it first.
    The sign of a component is arbitrary.
    """
    scaler = StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol="_centered")
    centered = scaler.fit(df).transform(df)
    model = PCA(k=k, inputCol="_centered", outputCol="_components").fit(centered)
    projected = model.transform(centered).withColumn("components", vector_to_array("_components"))
    return projected.drop("_centered", "_components"), model


def fit_forest(
    df: DataFrame, label: str, features: str = "features", trees: int = 20, depth: int = 5, seed: int = 7
) -> RandomForestRegressionModel:
    return RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    ).fit(df)


def _boosted(label: str, features: str, rounds: int, depth: int, seed: int) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed, stepSize=0.3
    )


def _leaf_values(model: GBTClassificationModel) -> np.ndarray:
    """Weighted value of each leaf, one row per tree; leaves count from left to right."""

    def leaves(node) -> list[float]:
        if node.getClass().getSimpleName() == "LeafNode":
            return [node.prediction()]
        return leaves(node.leftChild()) + leaves(node.rightChild())

    values = [leaves(tree.rootNode()) for tree in model._java_obj.trees()]
    table = np.zeros((len(values), max(map(len, values))))
    for row, found, weight in zip(table, values, model.treeWeights):
        row[: len(found)] = np.multiply(found, weight)
    return table


def error_by_round(model: GBTClassificationModel, rows: DataFrame, label: str) -> list[float]:
    """Share of wrong labels after each round, for all rounds in one pass over the rows.

    A row's leaves give the margin of every round as a running sum.
    """
    values = _leaf_values(model)
    rounds = np.arange(len(values))

    def count(batches):
        wrong, seen = np.zeros(len(values), np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                leaf = np.asarray(part["leaf"].flatten()).reshape(part.num_rows, -1).astype(np.int64)
                positive = np.cumsum(values[rounds, leaf], axis=1) > 0
                wrong += (positive != (np.asarray(part["actual"]) > 0.5)[:, None]).sum(axis=0)
                seen += part.num_rows
        columns = [pa.array(rounds), pa.array(wrong), pa.array(np.full(len(values), seen))]
        yield pa.RecordBatch.from_arrays(columns, ["round", "wrong", "seen"])

    leaves = model.copy().setLeafCol("_leaf").transform(rows)
    counted = leaves.select(
        vector_to_array("_leaf").alias("leaf"), F.col(label).cast("double").alias("actual")
    ).mapInArrow(count, "round long, wrong long, seen long")
    shares = counted.groupBy("round").agg(F.try_divide(F.sum("wrong"), F.sum("seen")).alias("error"))
    found = [r["error"] for r in shares.orderBy("round").collect()]
    if not found or found[0] is None:
        raise ValueError("no validation rows")
    return found


def first_rounds_of(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first rounds: later trees do not change earlier ones."""
    java = model._java_obj
    context = SparkSession.active().sparkContext
    trees = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for i, tree in enumerate(java.trees()[:rounds]):
        trees[i], weights[i] = tree, model.treeWeights[i]
    made = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{model.uid}_{rounds}", trees, weights)
    return GBTClassificationModel(made).setFeaturesCol(model.getFeaturesCol())


def fit_boosted(
    train: DataFrame,
    valid: DataFrame,
    label: str,
    features: str = "features",
    max_rounds: int = 2000,
    patience: int = 10,
    first_rounds: int = 32,
    depth: int = 3,
    seed: int = 7,
    metric: str = "error",
) -> tuple[GBTClassificationModel, DataFrame]:
    """Boosted trees kept at the best validation round, and the measure per round.

    ``metric`` is ``error``, the share of wrong labels, or ``loss``, Spark's
    validation loss. Rounds double until the stop rule fires or the limit is
    reached; the model is then cut after the best round.
    """
    ensure_checkpoint_dir(train.sparkSession)  # the estimator cuts its lineage every ten rounds
    rounds = min(first_rounds, max_rounds)
    while True:
        model = _boosted(label, features, rounds, depth, seed).fit(train)
        measured = error_by_round(model, valid, label) if metric == "error" else model.evaluateEachIteration(valid)
        curve = [(0, i + 1, float(x)) for i, x in enumerate(measured)]
        history = train.sparkSession.createDataFrame(curve, "run int, round int, metric double")
        chosen = early_stop_round(history, ["run"], patience).first()
        # A perfect fit can end with fewer trees than asked for.
        if chosen["stopped"] or rounds >= max_rounds or len(curve) < rounds:
            break
        rounds = min(2 * rounds, max_rounds)
    return first_rounds_of(model, chosen["best_round"]), history


def predict_margin(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    """Add ``margin`` (log-odds), ``probability_1`` and ``label_1``.

    Spark's raw score of boosted trees is half the log-odds.
    """
    scored = model.transform(df).withColumn(
        "margin", 2.0 * F.get(vector_to_array("rawPrediction"), F.lit(1))
    )
    scored = scored.withColumn("probability_1", sigmoid(F.col("margin")))
    return scored.withColumn("label_1", round_half_even(F.col("probability_1")))


def fit_perceptron(
    df: DataFrame,
    layers: Sequence[int],
    label: str = "label",
    features: str = "features",
    max_iter: int = 60,
    seed: int = 7,
) -> MultilayerPerceptronClassificationModel:
    """Feed-forward classifier trained on cross-entropy; hidden units are sigmoid."""
    return MultilayerPerceptronClassifier(
        layers=list(layers), featuresCol=features, labelCol=label, maxIter=max_iter, seed=seed
    ).fit(df)
