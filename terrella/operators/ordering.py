"""Sorts, limits, top-k and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.operators.positions import number_in_group


def head(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """The first n rows by an explicit order."""
    return df.orderBy(*order).limit(n)


def top_per_group(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], k: int, out: str = "rank"
) -> DataFrame:
    """The first k rows of each group, ranked from 1.

    Spark keeps k rows per group and task before the shuffle, so a heavy group
    sends at most k rows from each task.
    """
    group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(group)).filter(F.col(out) <= k)


def ranked_sort(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rank", **heavy_options) -> DataFrame:
    """Sort by keys and order, ascending, with the place inside each key, from 1, as a column.

    A heavy key is numbered in ranges of its order, not in one task.
    """
    numbered = number_in_group(df, keys, order, out, **heavy_options)
    return numbered.withColumn(out, (F.col(out) + 1).cast("int")).orderBy(*keys, *order)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of several tables; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
