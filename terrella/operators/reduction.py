"""Combining one bounded result per task in a tree, so that no task and not the driver meets all of them."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that are combined together, in a task or on the driver.
FAN_IN = 32


def reduce_in_tree(
    parts: DataFrame, tasks: int, combine: Callable[[pa.Table], pa.Table], fan_in: int = FAN_IN
) -> pa.Table | None:
    """``combine`` applied level by level to rows with a column ``part``, which counts from 0 up to ``tasks``.

    ``combine`` turns a table of up to ``fan_in`` rows, in the order of their
    parts, into one row of the same columns; its ``part`` does not matter. The
    driver combines the last ``fan_in`` rows. None if there are no rows.
    """
    columns = parts.columns

    def ordered(table: pa.Table) -> pa.Table:
        table = table.select(columns).sort_by("part")
        made = combine(table)
        part = pa.array([table["part"][0].as_py() // fan_in], pa.int32())
        return made.set_column(columns.index("part"), "part", part)

    while tasks > fan_in:
        level = F.floor(F.col("part") / fan_in).alias("_group")
        parts = parts.groupBy(level).applyInArrow(lambda key, table: ordered(table), parts.schema)
        tasks = -(-tasks // fan_in)
    found = parts.toArrow()
    return ordered(found) if found.num_rows else None
