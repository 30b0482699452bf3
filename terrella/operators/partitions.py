"""User functions on partitions, and placement of data."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.session import scratch_path


def map_partitions(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a pandas function to each Arrow batch; ``schema`` declares its output."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def map_reduce(
    df: DataFrame, column: str, fn: Callable[[pd.Series], pd.Series], kind: str = "double", out: str = "total"
) -> DataFrame:
    """Sum of a pandas function over a column of parameters."""
    return df.agg(F.sum(F.pandas_udf(fn, kind)(column)).alias(out))


def partition_count(rows: int, rows_per_partition: int = 1_000_000, workers: int = 1) -> int:
    """Partitions for a table of known size: at least one per worker."""
    return max(math.ceil(rows / rows_per_partition), workers, 1)


def pin(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread a table evenly over the executors and keep it in memory or on disk."""
    spread = df.repartition(partitions) if partitions else df
    return spread.persist(StorageLevel.MEMORY_AND_DISK)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that later steps do not compute it again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
