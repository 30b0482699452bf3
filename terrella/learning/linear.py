"""Linear prediction and gradient steps as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.functions.vectors import as_doubles, dot


def predict_line(df: DataFrame, feature: str, slope: Column, intercept: Column, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, slope * F.col(feature) + intercept)


def gradient_step(df: DataFrame, x: str, y: str, w: float, b: float, rate: float) -> DataFrame:
    """One step of least-squares descent: (grad_w, grad_b, w, b) after averaging over all rows."""
    residual = F.lit(float(w)) * F.col(x) + F.lit(float(b)) - F.col(y)
    gradients = df.agg(
        F.avg(2.0 * residual * F.col(x)).alias("grad_w"), F.avg(2.0 * residual).alias("grad_b")
    )
    return gradients.select(
        "grad_w",
        "grad_b",
        (F.lit(float(w)) - rate * F.col("grad_w")).alias("w"),
        (F.lit(float(b)) - rate * F.col("grad_b")).alias("b"),
    )


def gradient_step_vector(
    df: DataFrame, features: str, y: str, weights: Sequence[float], intercept: float, rate: float
) -> DataFrame:
    """One step of least-squares descent over all weights: (pos, gradient, weight).

    The last position is the intercept. Components are averaged inside each task
    before they are shuffled; rows without label, or with another number of
    features than weights, are left out.
    """
    size = len(weights)
    whole = df.filter(F.col(y).isNotNull() & (F.size(features) == size))
    start = F.array(*[F.lit(float(w)) for w in weights])
    residual = dot(F.col(features), start) + F.lit(float(intercept)) - F.col(y)
    one = F.array(F.lit(1.0))
    terms = F.zip_with(F.concat(as_doubles(F.col(features)), one), F.array_repeat(residual, size + 1), lambda x, r: 2.0 * r * x)
    mean = whole.select(F.posexplode(terms).alias("pos", "term")).groupBy("pos").agg(F.avg("term").alias("gradient"))
    before = F.get(F.concat(start, F.array(F.lit(float(intercept)))), F.col("pos"))
    return mean.select("pos", "gradient", (before - rate * F.col("gradient")).alias("weight"))
