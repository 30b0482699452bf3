"""Least squares and principal components from factors that tasks combine in a tree.

Least squares: every task reduces its rows to the R factor of a QR
factorisation, R factors are stacked and factored again. Nothing is squared, so
that nearly collinear features keep their digits.

Components: a block of random directions is multiplied by ``X^T X`` in passes
over the rows, orthonormalised in between. Memory is width times the number of
directions; no width by width matrix is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.operators.reduction import FAN_IN, reduce_in_tree

_KINDS = "part int, factor binary, rows long"


def _usable(df: DataFrame, features: str, *others: str) -> tuple[DataFrame, int]:
    """Rows whose features are as many as those of the longest row and, like the others, not null; and how many that are."""
    rows = df.select(
        F.col(features).cast("array<double>").alias("x"), *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(others)]
    )
    known = ~F.exists("x", lambda v: v.isNull()) & F.col("x").isNotNull()
    for i in range(len(others)):
        known = known & F.col(f"y{i}").isNotNull()
    rows = rows.filter(known)
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if width is None:
        raise ValueError("no rows")
    return rows.filter(F.size("x") == width), width


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _told(part: int, factor: np.ndarray, rows: int) -> pa.RecordBatch:
    cells = [pa.array([part], pa.int32()), pa.array([np.ascontiguousarray(factor).tobytes()], pa.binary()), pa.array([rows], pa.int64())]
    return pa.RecordBatch.from_arrays(cells, ["part", "factor", "rows"])


def _per_task(rows: DataFrame, start, step) -> tuple[DataFrame, int]:
    """One row (part, factor, rows) per task that has rows: ``step(factor, batch)`` over its batches."""
    numbered = rows.withColumn("_part", F.spark_partition_id())

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, seen, part = start(), 0, 0
        for batch in batches:
            if batch.num_rows:
                part, seen = batch.column("_part")[0].as_py(), seen + batch.num_rows
                factor = step(factor, batch)
        if seen:
            yield _told(part, factor, seen)

    return numbered.mapInArrow(over, _KINDS), rows.rdd.getNumPartitions()


def _combined(parts: DataFrame, tasks: int, shape: tuple[int, int], join, fan_in: int) -> tuple[np.ndarray, int]:
    def combine(table: pa.Table) -> pa.Table:
        factors = [np.frombuffer(b, np.float64).reshape(shape) for b in table["factor"].to_pylist()]
        return pa.Table.from_batches([_told(0, join(factors), sum(table["rows"].to_pylist()))])

    found = reduce_in_tree(parts, tasks, combine, fan_in)
    return np.frombuffer(found["factor"][0].as_py(), np.float64).reshape(shape), found["rows"][0].as_py()


def r_factor(rows: DataFrame, width: int, to_matrix, fan_in: int = FAN_IN) -> tuple[np.ndarray, int]:
    """R of the QR factorisation of all rows, ``to_matrix(batch)`` giving those of a batch; and the number of rows."""

    def squeezed(stacked: np.ndarray) -> np.ndarray:
        factor = np.linalg.qr(stacked, mode="r")
        return np.vstack([factor, np.zeros((width - len(factor), width))])

    parts, tasks = _per_task(
        rows, lambda: np.zeros((width, width)), lambda factor, batch: squeezed(np.vstack([factor, to_matrix(batch)]))
    )
    return _combined(parts, tasks, (width, width), lambda factors: squeezed(np.vstack(factors)), fan_in)


@dataclass
class Line:
    """A fitted hyperplane, the sum of squared residuals, the rank of features and intercept, and the rows fitted."""

    coefficients: np.ndarray
    intercept: float
    residual: float
    rank: int
    rows: int

    def predict(self, features: Column) -> Column:
        terms = F.zip_with(features, F.array(*[F.lit(float(c)) for c in self.coefficients]), lambda x, c: x * c)
        return F.aggregate(terms, F.lit(self.intercept), lambda a, b: a + b)


def least_squares(df: DataFrame, features: str, label: str, fan_in: int = FAN_IN) -> Line:
    """Least squares with intercept over an array of features, by tall-skinny QR.

    Columns without any share of their own (rank below the width) get the
    solution of least norm. Rows with a null, or with another number of features
    than the longest row, are left out. Without usable rows it raises ValueError.
    """
    rows, width = _usable(df, features, label)

    def widened(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([np.ones(batch.num_rows), _rows(batch, width), batch.column("y0").to_numpy()])

    factor, seen = r_factor(rows, width + 2, widened, fan_in)
    inner, right = factor[: width + 1, : width + 1], factor[: width + 1, -1]
    # Columns are scaled first, so that the rank does not hang on their units.
    scale = np.sqrt((inner**2).sum(axis=0))
    scale[scale == 0] = 1.0
    solved, _, rank, _ = np.linalg.lstsq(inner / scale, right, rcond=width * np.finfo(float).eps)
    solved = solved / scale
    residual = float(((inner @ solved - right) ** 2).sum() + factor[-1, -1] ** 2)
    return Line(solved[1:], float(solved[0]), residual, int(rank), seen)


@dataclass
class Components:
    """Principal components: means, one component per row of ``axes``, and the variance along each."""

    means: np.ndarray
    axes: np.ndarray
    variances: np.ndarray

    def project(self, features: Column) -> Column:
        """Centered features along the components; null for other numbers of features."""
        means, axes = self.means, self.axes

        @F.pandas_udf("array<double>")
        def along(rows: pd.Series) -> pd.Series:
            held = [i for i, r in enumerate(rows) if r is not None and len(r) == len(means)]
            out = [None] * len(rows)
            if held:
                for i, found in zip(held, (np.stack(rows.iloc[held].to_list()) - means) @ axes.T):
                    out[i] = found
            return pd.Series(out, dtype=object)

        return along(features.cast("array<double>"))


def principal_components(
    df: DataFrame, features: str, k: int = 2, spare: int = 8, passes: int = 30, tolerance: float = 1e-9, seed: int = 7,
    fan_in: int = FAN_IN,
) -> Components:
    """The first k components of centered features, by block power iteration.

    ``spare`` directions go along to speed up convergence. Passes end when the
    variances of the first k change by less than ``tolerance`` of the first, or
    after ``passes``. The sign of a component makes its largest entry positive. Rows are left out as in
    :func:`least_squares`; fewer than two are an error.
    """
    rows, width = _usable(df, features)
    rows = rows.persist()
    parts, tasks = _per_task(rows, lambda: np.zeros(width), lambda total, batch: total + _rows(batch, width).sum(axis=0))
    total, seen = _combined(parts, tasks, (1, width), sum, fan_in)
    if seen < 2:
        raise ValueError("components need two rows")
    means = total[0] / seen
    size = min(k + spare, width)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    before = None
    for _ in range(passes):

        def times(product: np.ndarray, batch: pa.RecordBatch, basis=basis) -> np.ndarray:
            centered = _rows(batch, width) - means
            return product + centered.T @ (centered @ basis)

        parts, tasks = _per_task(rows, lambda: np.zeros((width, size)), times)
        product, _ = _combined(parts, tasks, (width, size), sum, fan_in)
        variances, turned = np.linalg.eigh(basis.T @ product / (seen - 1))
        order = np.argsort(variances)[::-1][: min(k, size)]
        found = variances[order]
        axes = (basis @ turned[:, order]).T
        done = before is not None and np.abs(found - before).max() <= tolerance * max(found[0], 0.0)
        if done:
            break
        before, basis = found, np.linalg.qr(product)[0]
    rows.unpersist()
    largest = np.abs(axes).argmax(axis=1)
    axes = axes * np.where(axes[np.arange(len(axes)), largest] < 0, -1.0, 1.0)[:, None]
    return Components(means, axes, np.maximum(found, 0.0))
