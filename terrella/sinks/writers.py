"""Writers for previews, run records and grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_head(df: DataFrame, path: str, order: Sequence[Column | str], n: int = 20) -> None:
    """The first n rows by an explicit order, as one CSV file with a header."""
    df.orderBy(*order).limit(n).coalesce(1).write.option("header", True).csv(path)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append one line ``workers seconds`` per run."""
    runs.select("workers", "seconds").write.mode("append").option("sep", " ").csv(path)


def grid_rows(cells: DataFrame, step: float = 0.1) -> DataFrame:
    """Grid cells as plot points: x to the right, y downward (never -0.0)."""
    return cells.select(
        (F.col("j") * step).alias("x"), (F.col("i") * -step + 0.0).alias("y"), F.col("v").alias("value")
    )


def write_grid(cells: DataFrame, path: str, step: float = 0.1) -> None:
    grid_rows(cells, step).write.option("sep", "\t").csv(path)
