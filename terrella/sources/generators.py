"""Generators driven by an id column.

Every value is a function of the row's id and a seed, not of the partition it
sits in: a retried task, or another partition count, gives the same table. Pass
``spark.range(n)`` or the key column of any table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from random import Random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.functions.numeric import drawn_bits

def uniform(id_column: Column, seed: int, stream: int = 0) -> Column:
    """Uniform value in (0, 1), from 52 bits of a digest that any SQL engine can compute."""
    return (drawn_bits(13, id_column, seed, stream).cast("double") + 0.5) / float(1 << 52)


def normal(id_column: Column, seed: int, stream: int = 0) -> Column:
    """Standard normal value, by the Box-Muller transform of two uniform ones."""
    radius = F.sqrt(-2.0 * F.log(uniform(id_column, seed, 2 * stream)))
    return radius * F.cos(2.0 * math.pi * uniform(id_column, seed, 2 * stream + 1))


def key_value(ids: DataFrame, seed: int, id_column: str = "id") -> DataFrame:
    """Key 0 or 1 with equal chance, value standard normal."""
    i = F.col(id_column)
    return ids.select(
        i, (uniform(i, seed, 7) < 0.5).cast("int").alias("key"), normal(i, seed).alias("value")
    )


def blob_centers(n_centers: int, n_features: int, seed: int, box: float = 10.0) -> list[list[float]]:
    """Centers drawn evenly from a cube of side ``2 * box``."""
    draw = Random(seed)
    return [[draw.uniform(-box, box) for _ in range(n_features)] for _ in range(n_centers)]


def blobs(
    ids: DataFrame, centers: Sequence[Sequence[float]], std: float, seed: int, id_column: str = "id"
) -> DataFrame:
    """Gaussian points around centers picked at random: (id, label, features)."""
    i = F.col(id_column)
    label = F.floor(uniform(i, seed, -1) * len(centers)).cast("int")
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    noise = F.array(*[normal(i, seed, j) for j in range(len(centers[0]))])
    return ids.select(i, label.alias("label")).select(
        "*", F.zip_with(F.get(table, F.col("label")), noise, lambda c, z: c + std * z).alias("features")
    )


def regression_coefficients(n_features: int, n_informative: int, seed: int) -> list[float]:
    """True coefficients: ``n_informative`` of them in (0, 100), the rest zero."""
    draw = Random(seed)
    informative = set(draw.sample(range(n_features), n_informative))
    return [100.0 * draw.random() if j in informative else 0.0 for j in range(n_features)]


def regression(
    ids: DataFrame,
    coefficients: Sequence[float],
    bias: float,
    noise: float,
    seed: int,
    id_column: str = "id",
) -> DataFrame:
    """Standard normal features and ``y = features . coefficients + bias + noise``."""
    i = F.col(id_column)
    width = len(coefficients)
    x = ids.select(i, F.array(*[normal(i, seed, j) for j in range(width)]).alias("features"))
    weighted = F.zip_with("features", F.array(*[F.lit(float(c)) for c in coefficients]), lambda a, b: a * b)
    y = F.aggregate(weighted, F.lit(float(bias)), lambda total, t: total + t)
    return x.withColumn("y", y + noise * normal(i, seed, width))


def noisy_line(
    ids: DataFrame, count: Column, slope: float = 2.0, bias: float = 1.0, noise: float = 1.0,
    seed: int = 0, id_column: str = "id",
) -> DataFrame:
    """Evenly spaced x over [0, 10] for ids 0 .. count - 1, and a line with noise."""
    i = F.col(id_column)
    x = ids.select(i, (i * 10.0 / (count - 1)).alias("x"))
    return x.withColumn("y", slope * F.col("x") + bias + noise * normal(i, seed))


def merge_pair(
    ids: DataFrame, matched: Column, shift: Column | int, id_column: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Two tables for a join test: right keys without ``matched`` fall out of range."""
    i = F.col(id_column)
    left = ids.select(i.alias("key"), (i * 2).alias("left_value"))
    key = F.when(matched, i).otherwise(i + shift)
    return left, ids.select(key.alias("key"), (i * 3).alias("right_value"))
