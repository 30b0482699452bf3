"""Positions inside ordered groups without putting a heavy group into one task.

Ordinary groups use one window. A heavy group is cut into chunks along its
order: rows are numbered inside their chunk, chunk sizes are added up in
order, and the sum of the chunks before is added to each row's number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.operators.partitions import keep
from terrella.operators.skew import TASK_ROWS, null_safe_join, split_heavy

CHUNK = "_chunk"
#: Chunks whose sums are added up together.
STRETCH = 1024


def chunk_count(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """A power of two, so that a chunk holds about ``rows`` rows however long the table is."""
    return 1 << max(3, math.ceil(df.count() / rows).bit_length())


def quantile_chunks(df: DataFrame, by: str, chunks: int | None = None) -> DataFrame:
    """Add ``_chunk``: the quantile range of the numeric or time column ``by``."""
    chunks = chunks or chunk_count(df)
    value = F.col(by)
    if dict(df.dtypes)[by].startswith(("timestamp", "date")):
        value = F.unix_micros(value.cast("timestamp"))
    ranged = df.withColumn("_by", value.cast("double"))
    cuts = ranged.approxQuantile("_by", [i / chunks for i in range(1, chunks)], 0.25 / chunks)
    inner = sorted({c for c in cuts if c == c and abs(c) != float("inf")})
    if not inner:
        return ranged.withColumn(CHUNK, F.lit(0)).drop("_by")
    bounds = [-float("inf"), *inner, float("inf")]
    cutter = Bucketizer(splits=bounds, inputCol="_by", outputCol="_b", handleInvalid="keep")
    # Nulls sort first in Spark, hence the chunk below all others.
    chunk = F.coalesce(F.col("_b").cast("int"), F.lit(-1))
    return cutter.transform(ranged).withColumn(CHUNK, chunk).drop("_by", "_b")


def range_chunks(df: DataFrame, by: Sequence[str], rows: int = TASK_ROWS) -> DataFrame:
    """Add ``_chunk``, which rises along all the columns ``by`` and holds about ``rows`` rows.

    The order is cut as a whole: a value that repeats in the first column, null
    included, is cut along the next ones. Only rows equal in all of ``by`` stay
    together. Chunks are as many as the rows need. The cuts come from a sample,
    so the table is written to the shared folder, where all later steps see
    the same chunks.
    """
    chunks = max(8, math.ceil(df.count() / rows))
    return keep(df.repartitionByRange(chunks, *by).withColumn(CHUNK, F.spark_partition_id()), "chunks")


def hash_chunks(hash_column: Column, chunks: int) -> Column:
    """Chunk of a 64-bit hash, rising with the hash, all about equal.

    ``chunks`` is a power of two: the chunk is the top bits of the hash.
    """
    return (F.shiftright(hash_column, 65 - chunks.bit_length()) + chunks // 2).cast("int")


def running_offsets(totals: DataFrame, amount: str, keys: Sequence[str] = ()) -> DataFrame:
    """Turn one row per (keys, chunk) into ``_before``, the sum of earlier chunks, and ``_all``.

    A chunk stands for about a million rows, so that even the largest tables
    have some hundred thousand. Without keys they are added up in two levels:
    inside stretches of 1024 chunks, and over the stretches, which become one array.
    """
    if keys:
        earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        all_chunks = Window.partitionBy(*keys)
        return totals.select(
            *keys,
            CHUNK,
            F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias("_before"),
            F.sum(amount).over(all_chunks).alias("_all"),
        )
    stretched = totals.select(CHUNK, F.col(amount).cast("bigint").alias("amount"), F.floor(F.col(CHUNK) / STRETCH).alias("_stretch"))
    ordered = "array_sort(collect_list(struct(_stretch, amount)))"
    summed = """aggregate(_pieces, struct(cast(array() as array<bigint>) as befores, 0L as total),
        (sum, piece) -> struct(array_append(sum.befores, sum.total) as befores, sum.total + piece.amount as total))"""
    pieces = stretched.groupBy("_stretch").agg(F.sum("amount").alias("amount")).agg(F.expr(ordered).alias("_pieces"))
    tops = pieces.withColumn("_sums", F.expr(summed)).select(
        F.inline(
            F.expr(
                "zip_with(_pieces, _sums.befores, (piece, before) -> "
                "struct(piece._stretch as _top, before as _above, _sums.total as _all))"
            )
        )
    )
    earlier = Window.partitionBy("_stretch").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inside = stretched.withColumn("_inside", F.coalesce(F.sum("amount").over(earlier), F.lit(0)))
    # One row per 1024 chunks.
    met = inside.join(F.broadcast(tops), F.col("_stretch") == F.col("_top"))
    return met.select(CHUNK, (F.col("_inside") + F.col("_above")).alias("_before"), "_all")


def number_chunked(
    df: DataFrame,
    order: Sequence[Column | str],
    out: str,
    keys: Sequence[str] = (),
    size: str | None = None,
) -> DataFrame:
    """Zero-based positions for a table that already has a ``_chunk`` column."""
    by = [*keys, CHUNK]
    offsets = running_offsets(df.groupBy(*by).agg(F.count("*").alias("_n")), "_n", keys)
    if not keys:
        offsets = F.broadcast(offsets)  # one row per million of the table's
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    numbered = null_safe_join(df.withColumn("_inside", inside), offsets, by)
    numbered = numbered.withColumn(out, (F.col("_inside") + F.col("_before")).cast("long"))
    if size:
        numbered = numbered.withColumn(size, F.col("_all").cast("long"))
    return numbered.drop("_inside", "_before", "_all", CHUNK)


def number_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "position",
    size: str | None = None,
    task_rows: int = TASK_ROWS,
    **heavy_options,
) -> DataFrame:
    """Zero-based position of each row in its group, and optionally the group size.

    The order columns sort ascending, nulls first.
    """
    keys, order = list(keys), list(order)
    cold, hot = split_heavy(df, keys, task_rows, **heavy_options)
    group = Window.partitionBy(*keys)
    plain = cold.withColumn(out, (F.row_number().over(group.orderBy(*order)) - 1).cast("long"))
    if size:
        plain = plain.withColumn(size, F.count("*").over(group))
    if hot is None:
        return plain
    chunked = number_chunked(range_chunks(hot, [*keys, *order], task_rows), order, out, keys, size)
    return plain.unionByName(chunked)
