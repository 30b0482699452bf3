"""Train and test splits that depend on row keys only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.functions.numeric import drawn_bits
from terrella.operators.positions import number_in_group


def split_by(df: DataFrame, in_test: Column) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; a null condition counts as train."""
    test = F.coalesce(in_test, F.lit(False))
    return df.filter(~test), df.filter(test)


def split_seeded(
    df: DataFrame, keys: Sequence[str], test_share: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Split by a seeded hash of the key columns, so no rerun moves a row."""
    return split_by(df, in_test_set(keys, test_share, seed))


def in_test_set(keys: Sequence[str], test_share: float, seed: int) -> Column:
    steps = 1_000_000
    return drawn_bits(13, *map(F.col, keys), seed) % steps < round(test_share * steps)


#: Bits of a draw, and how many of them one histogram pass resolves.
DRAW_BITS, PASS_BITS = 60, 12


def kth_smallest(df: DataFrame, draw: str, k: int) -> tuple[int, int]:
    """The k-th smallest (from 1) of a column of draws, and how many draws are below it.

    Each pass counts the draws by their next bits, among those that share the
    bits already known: a histogram of at most 4096 rows comes to the driver.
    """
    known, below = 0, 0
    for shift in range(DRAW_BITS - PASS_BITS, -1, -PASS_BITS):
        same = F.shiftright(draw, shift + PASS_BITS) == known
        digit = F.shiftright(draw, shift).bitwiseAND((1 << PASS_BITS) - 1)
        counts = df.filter(same).groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).orderBy("digit").collect()
        for row in counts:
            if below + row["n"] >= k:
                known = (known << PASS_BITS) | row["digit"]
                break
            below += row["n"]
    return known, below


def split_exact(
    df: DataFrame, keys: Sequence[str], test_share: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """A shuffled split with exactly ``round(test_share * rows)`` test rows.

    Rows with the smallest draws of a seeded hash of the keys are test rows. Of
    rows that share the last such draw, full copies most of all, the first in
    the order of the keys are.
    """
    if not 0 <= test_share <= 1:
        raise ValueError("a share lies between 0 and 1")
    drawn = df.withColumn("_draw", drawn_bits(DRAW_BITS // 4, *map(F.col, keys), seed))
    wanted = round(test_share * df.count())
    if wanted == 0:
        return df, df.limit(0)
    last, below = kth_smallest(drawn, "_draw", wanted)
    ties = number_in_group(drawn.filter(F.col("_draw") == last), ["_draw"], list(keys), "_place")
    rest = drawn.filter(F.col("_draw") != last).withColumn("_place", F.lit(0).cast("long"))
    marked = ties.unionByName(rest)
    test = (F.col("_draw") < last) | (F.col("_draw") == last) & (F.col("_place") < wanted - below)
    return marked.filter(~test).drop("_draw", "_place"), marked.filter(test).drop("_draw", "_place")
