"""Choice of the training round from a validation curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def early_stop_round(history: DataFrame, run_keys: Sequence[str], patience: int = 10) -> DataFrame:
    """Best round of each run: (run keys, best_round, best_metric, last_round, stopped).

    ``history`` has ``round`` (from 1, without gaps) and ``metric`` (smaller is
    better). Training stops at the first round that is ``patience`` rounds
    after the best so far; later rounds do not count.
    """
    so_far = Window.partitionBy(*run_keys).orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    # The earliest round with the smallest metric so far.
    best = F.min(F.struct("metric", "round")).over(so_far)
    traced = history.withColumn("_best", best).withColumn(
        "_fires", F.col("round") - F.col("_best.round") >= patience
    )
    stops = F.min(F.when(F.col("_fires"), F.col("round"))).over(Window.partitionBy(*run_keys))
    kept = traced.withColumn("_stop", stops).filter(
        F.col("_stop").isNull() | (F.col("round") <= F.col("_stop"))
    )
    final = F.min(F.struct("metric", "round"))
    return kept.groupBy(*run_keys).agg(
        final["round"].alias("best_round"),
        final["metric"].alias("best_metric"),
        F.max("round").alias("last_round"),
        F.max(F.col("_stop").isNotNull()).alias("stopped"),
    )
