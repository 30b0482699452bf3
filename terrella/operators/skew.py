"""Finding heavy keys, and joining or ranking around them.

A key is *heavy* when it holds more rows than one task handles well. The list
of heavy keys only steers how rows are spread: a missed or a needless key never
changes a result, so the list can be cut to the ``MAX_KEYS`` heaviest, which
makes it safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a single task handles well.
TASK_ROWS = 1_000_000
#: Longest list of heavy keys.
MAX_KEYS = 100_000
SAMPLE_FRACTION = 0.01


def _heaviest(df: DataFrame, keys: Sequence[str], rows: float) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= rows)
    return counts.orderBy(F.desc("_rows"), *keys).limit(MAX_KEYS)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet null keys; the keys are those of ``left``."""
    theirs = right.withColumnsRenamed({k: f"_right_{k}" for k in on})
    same = reduce(and_, (left[k].eqNullSafe(theirs[f"_right_{k}"]) for k in on))
    return left.join(theirs, same, how).drop(*[f"_right_{k}" for k in on])


def split_heavy(
    df: DataFrame,
    keys: Sequence[str],
    task_rows: int = TASK_ROWS,
    sample_fraction: float = SAMPLE_FRACTION,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of heavy groups if there are any.

    A small job counts a sample of the key columns, so that tables without
    heavy groups keep their plain plan. Null is a key like any other.
    """
    keys = list(keys)
    sampled = df.select(*keys).sample(fraction=sample_fraction, seed=17)
    found = _heaviest(sampled, keys, max(1.0, task_rows * sample_fraction)).drop("_rows").collect()
    if not found:
        return df, None
    listed = F.broadcast(df.sparkSession.createDataFrame(found, df.select(*keys).schema))
    return null_safe_join(df, listed, keys, "left_anti"), null_safe_join(df, listed, keys, "left_semi")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Inner equi-join in which each key with many pairs is cut into salts.

    For joins whose work grows with the product of both sides of a key; the
    skew handling of adaptive execution looks at bytes only. Rows per key are
    counted on both sides, and a key with ``task_rows`` pairs or more is cut on
    the side that has more rows of it; the other side is copied once per salt.

    ``spread`` names left columns that differ between rows of one key; the right
    side is spread by all its columns. Their hash, mixed with the number of the partition the row sits in, picks the
    salt: a retried task picks the same one, and full copies of a row still
    spread as they come from many partitions.
    """
    on = list(on)
    rows = [side.groupBy(*on).agg(F.count("*").alias(n)) for side, n in ((left, "_left"), (right, "_right"))]
    pairs = F.col("_left").cast("double") * F.col("_right")
    many = rows[0].join(rows[1].hint("merge"), on).withColumn("_rows", pairs).filter(F.col("_rows") >= task_rows)
    most = F.greatest("_left", "_right")
    salts = F.least(F.ceil(F.col("_rows") / task_rows), most).cast("int")
    cut_left = F.col("_left") >= F.col("_right")
    heavy = F.broadcast(
        many.orderBy(F.desc("_rows"), *on).limit(MAX_KEYS).select(
            *on, F.when(cut_left, salts).otherwise(1).alias("_ls"), F.when(cut_left, 1).otherwise(salts).alias("_rs")
        )
    )

    def salted(side: DataFrame, own: str, other: str, mixed: Sequence[str]) -> DataFrame:
        """Rows with a salt of their own out of ``own`` and a copy for each of ``other``."""
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), *mixed), F.coalesce(own, F.lit(1))).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        marked = side.join(heavy, on, "left").withColumn(f"_salt{own}", salt).withColumn(f"_salt{other}", copies)
        return marked.drop("_ls", "_rs")

    # Copies are not in the estimated size of a side: without the merge hint a large one may be broadcast.
    met = salted(left, "_ls", "_rs", spread).join(
        salted(right, "_rs", "_ls", right.columns).hint("merge"), [*on, "_salt_ls", "_salt_rs"]
    )
    return met.drop("_salt_ls", "_salt_rs")
