"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_mean(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def normalized_group_sum(
    df: DataFrame, keys: Sequence[str], value: str, population: DataFrame, by: Sequence[str], out: str = "total"
) -> DataFrame:
    """Group sums divided by the number of ``population`` rows with the same ``by`` key.

    Population rows without a match in ``df`` count as well.
    """
    counts = population.groupBy(*by).agg(F.count("*").alias("_population"))
    sums = group_sum(df, keys, value, "_sum").join(counts, list(by))
    return sums.select(*keys, (F.col("_sum") / F.col("_population")).alias(out))


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def partial_and_global_mean(df: DataFrame, part: Column, key: str, value: str) -> DataFrame:
    """Mean per (part, key) next to the mean per key over all parts.

    The parts are summed once; the global mean is built from their sums.
    """
    parts = df.groupBy(part.alias("part"), F.col(key)).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )
    overall = parts.groupBy(key).agg((F.sum("_sum") / F.sum("_count")).alias("global_mean"))
    partial = parts.select("part", key, (F.col("_sum") / F.col("_count")).alias("part_mean"))
    return partial.join(overall, key)


def midpoint_integral(cells: DataFrame, index: str, count: Column, out: str = "integral") -> DataFrame:
    """Integral of 4 / (1 + x^2) over [0, 1] with one midpoint per row.

    ``index`` numbers the rows from 0; ``count`` is their number.
    """
    points = cells.select(((F.col(index) + 0.5) / count).alias("x"), (1.0 / count).alias("step"))
    x = F.col("x")
    return points.agg(F.sum(4.0 / (1.0 + x * x) * F.col("step")).alias(out))


def with_total(df: DataFrame, value: str, out: str = "total") -> DataFrame:
    """Give every row the sum over the whole table."""
    return df.withColumn(out, df.agg(F.sum(value).alias(out)).scalar())


def gather_ordered(
    df: DataFrame, keys: Sequence[str], position: str, value: str, block: int = 4096
) -> DataFrame:
    """Pieces of each owner in order, as arrays of at most ``block`` elements.

    Positions are whole numbers, unique within an owner. Block b holds the
    positions [b * block, (b + 1) * block), so an owner of any size spreads
    over many rows, and its blocks read one after the other give its pieces
    in order.
    """
    owner_block = F.floor(F.col(position) / block).alias("block")
    pieces = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(value).alias("v"))))
    gathered = df.groupBy(*keys, owner_block).agg(pieces.alias("_pieces"))
    return gathered.select(*keys, "block", F.col("_pieces.v").alias("pieces"))


def max_abs_change(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Largest absolute difference between two versions of a table."""
    before = old.select(*keys, F.col(value).alias("_old"))
    after = new.select(*keys, F.col(value).alias("_new"))
    change = F.abs(F.col("_new") - F.col("_old"))
    return before.join(after, list(keys)).agg(F.max(change).alias("max_change"))


def diff_count(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1e-6) -> DataFrame:
    """Number of cells that differ by more than the tolerance or exist on one side only."""
    a = left.select(*keys, F.col(value).alias("_a"))
    b = right.select(*keys, F.col(value).alias("_b"))
    gap = F.abs(F.col("_a") - F.col("_b"))
    joined = a.join(b, list(keys), "full")
    return joined.agg(F.count_if((gap > tolerance) | gap.isNull()).alias("n_diff"))


def column_means(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean of each column as rows (name, mean)."""
    row = df.agg(*[F.avg(c).alias(c) for c in names])
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("mean")) for c in names]))
    )


def covariance_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sample covariance of every two columns as rows (row, col, cov), in one pass."""
    upper = list(combinations_with_replacement(range(len(names)), 2))
    row = df.agg(*[F.covar_samp(names[a], names[b]).alias(f"c{a}_{b}") for a, b in upper])
    entries = [
        F.struct(
            F.lit(a).alias("row"),
            F.lit(b).alias("col"),
            F.col(f"c{min(a, b)}_{max(a, b)}").alias("cov"),
        )
        for a in range(len(names))
        for b in range(len(names))
    ]
    return row.select(F.inline(F.array(*entries)))


def vector_covariance(df: DataFrame, vector: str) -> DataFrame:
    """Sample covariance of every two components of a vector column as rows (row, col, cov).

    For wide vectors: each task adds up one matrix of products around the means
    and only these matrices are shuffled. Null vectors are left out; vectors of
    different lengths are an error.
    """
    known = df.select(F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    # One mean per component: as many rows as a vector has components.
    means = known.select(F.posexplode("v").alias("pos", "x")).groupBy("pos").agg(F.avg("x").alias("m"), F.count("*").alias("n"))
    found = sorted(tuple(r) for r in means.collect())
    if len({n for _, _, n in found}) > 1:
        raise ValueError("vectors of different lengths")
    center, rows = np.array([m for _, m, _ in found]), found[0][2] if found else 0
    width = len(center)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
            gaps = flat.reshape(batch.num_rows, width) - center
            total += gaps.T @ gaps
        row, col = np.indices((width, width)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(col), pa.array(total.ravel())], ["row", "col", "part"])

    parts = known.mapInArrow(products, "row int, col int, part double")
    return parts.groupBy("row", "col").agg(F.try_divide(F.sum("part"), F.lit(rows - 1.0)).alias("cov"))
