"""Expressions on ``ARRAY<FLOAT|DOUBLE>`` columns; sums run in double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def array_sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))
    return array_sum(gaps)


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def argmax(v: Column) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def _with_each(v: Column, value: Column, fn) -> Column:
    # array_repeat evaluates ``value`` once per row; inside a lambda it would
    # be evaluated again for every element.
    return F.zip_with(as_doubles(v), F.array_repeat(value, F.size(v)), fn)


def log_sum_exp(v: Column) -> Column:
    top = F.array_max(as_doubles(v))
    return top + F.log(array_sum(_with_each(v, top, lambda x, t: F.exp(x - t))))


def softmax(v: Column) -> Column:
    """Exponentials shifted by the maximum and scaled to sum to one."""
    return _with_each(v, log_sum_exp(v), lambda x, t: F.exp(x - t))


def cross_entropy(logits: Column, label: Column) -> Column:
    """Negative log of the softmax weight at ``label`` (zero-based)."""
    return log_sum_exp(logits) - F.get(as_doubles(logits), label)


def scale_by(v: Column, factors: Sequence[float]) -> Column:
    """Multiply component j by ``factors[j]``."""
    weights = F.array(*[F.lit(float(f)) for f in factors])
    return F.zip_with(as_doubles(v), weights, lambda x, w: x * w)


def normalize(v: Column, mean: float, std: float) -> Column:
    return F.transform(as_doubles(v), lambda x: (x - F.lit(float(mean))) / F.lit(float(std)))


def normalize_channels(channels: Column, means: Sequence[float], stds: Sequence[float]) -> Column:
    """Normalise each channel (an array of arrays) by its own mean and deviation."""
    if len(means) != len(stds):
        raise ValueError(f"{len(means)} means for {len(stds)} deviations")
    pairs = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(means, stds)])
    wrong = F.raise_error(F.concat(F.lit(f"expected {len(means)} channels, found "), F.size(channels).cast("string")))
    checked = F.when(F.size(channels) == len(means), channels).when(channels.isNotNull(), wrong.cast("array<array<double>>"))
    return F.zip_with(checked, pairs, lambda c, p: F.transform(as_doubles(c), lambda x: (x - p["m"]) / p["s"]))


def channels_of(v: Column, width: int) -> Column:
    """Cut a vector into channels of ``width`` components."""
    starts = F.sequence(F.lit(1), F.size(v), F.lit(width))
    return F.when(F.size(v) > 0, F.transform(starts, lambda i: F.slice(as_doubles(v), i, F.lit(width))))


def every_kth(v: Column, k: int) -> Column:
    """Elements at positions 0, k, 2k, ..."""
    return F.filter(v, lambda x, i: i % k == 0)
