"""Blocks, offsets, neighbours, batches, shards and stencils."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.functions.numeric import drawn_bits
from terrella.operators.positions import (
    CHUNK,
    chunk_count,
    hash_chunks,
    number_chunked,
    number_in_group,
    quantile_chunks,
    range_chunks,
    running_offsets,
)
from terrella.operators.skew import TASK_ROWS, null_safe_join, split_heavy
from terrella.session import ensure_checkpoint_dir


def block_of(position: Column, size: Column, owners: int) -> Column:
    """Owner of an item when ``size`` items go to owners in balanced blocks.

    The first ``size mod owners`` owners get one item more than the others.
    """
    quota = F.floor(size / owners)
    extra = size % owners
    long_part = extra * (quota + 1)
    in_long = F.floor(position / (quota + 1))
    in_short = extra + F.floor(F.try_divide(position - long_part, quota))
    return F.when(position < long_part, in_long).otherwise(in_short).cast("int")


def balanced_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], owners: int, out: str = "owner", **heavy_options
) -> DataFrame:
    """Assign the ordered rows of each group to owners 0 .. owners - 1."""
    numbered = number_in_group(df, keys, order, "_position", "_size", **heavy_options)
    owner = block_of(F.col("_position"), F.col("_size"), owners)
    return numbered.withColumn(out, owner).drop("_position", "_size")


def block_offsets(df: DataFrame, owner: str, out: str = "offset") -> DataFrame:
    """Rows per owner and the number of rows of all owners before it: (owner, n, offset).

    Counting comes first. The counts, one per owner, are summed up over
    quantile ranges of the owner, so any number of owners works.
    """
    counts = quantile_chunks(df.groupBy(owner).agg(F.count("*").alias("n")), owner)
    offsets = running_offsets(counts.groupBy(CHUNK).agg(F.sum("n").alias("n")), "n")
    earlier = Window.partitionBy(CHUNK).orderBy(owner).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    placed = counts.withColumn("_inside", inside).join(F.broadcast(offsets), CHUNK)
    return placed.select(owner, "n", (F.col("_inside") + F.col("_before")).alias(out))


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    default,
    out: str = "previous",
    task_rows: int = TASK_ROWS,
    **heavy_options,
) -> DataFrame:
    """Value of the row before, within the group; ``default`` for the first row."""
    keys, order = list(keys), list(order)
    cold, hot = split_heavy(df, keys, task_rows, **heavy_options)
    plain = cold.withColumn(out, F.lag(value, 1, default).over(Window.partitionBy(*keys).orderBy(*order)))
    if hot is None:
        return plain
    ranged = range_chunks(hot, [*keys, *order], task_rows)
    by = [*keys, CHUNK]
    # The last value of each chunk is what the first row of the next one sees.
    last = ranged.groupBy(*by).agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    carried = last.select(
        *by, F.lag("_last").over(Window.partitionBy(*keys).orderBy(CHUNK)).alias("_carried")
    )
    inside = Window.partitionBy(*by).orderBy(*order)
    chunked = (
        ranged.withColumn("_inside", F.lag(F.struct(value)).over(inside))
        .transform(lambda rows: null_safe_join(rows, carried, by))
        .withColumn("_seen", F.coalesce("_inside", "_carried"))
        .withColumn(
            out,
            F.when(F.col("_seen").isNull(), F.lit(default).cast(df.schema[value].dataType)).otherwise(
                F.col(f"_seen.{value}")
            ),
        )
        .drop("_inside", "_carried", "_seen", CHUNK)
    )
    return plain.unionByName(chunked)


def every_kth_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, **heavy_options
) -> DataFrame:
    """Rows at positions 0, k, 2k, ... of each group."""
    numbered = number_in_group(df, keys, order, "_position", **heavy_options)
    return numbered.filter(F.col("_position") % k == 0).drop("_position")


def assign_batches(
    df: DataFrame,
    shard: str,
    order: Sequence[str],
    batch_size: int,
    drop_last: bool = False,
    out: str = "batch",
    **heavy_options,
) -> DataFrame:
    """Cut the ordered rows of each shard into batches; a short last one may be dropped."""
    numbered = number_in_group(df, [shard], order, "_position", "_size", **heavy_options)
    if drop_last:
        numbered = numbered.filter(F.col("_position") < F.col("_size") - F.col("_size") % batch_size)
    batch = F.floor(F.col("_position") / batch_size)
    return numbered.withColumn(out, batch).drop("_position", "_size")


def epoch_shards(df: DataFrame, id_column: str, epoch: int, shards: int) -> DataFrame:
    """Shuffle by an epoch-seeded hash and deal the rows to shards in turn.

    Shards have equal size: rows from the start of the order are dealt again
    until the count divides evenly. Adds ``shard`` and ``slot``, the place
    inside the shard.
    """
    # 60 bits of a digest, moved to the whole range of a signed number.
    bits = drawn_bits(15, F.col(id_column), epoch)
    mixed = df.withColumn("_mix", (bits - (1 << 59)) * 16)
    mixed = mixed.withColumn(CHUNK, hash_chunks(F.col("_mix"), chunk_count(df)))
    numbered = number_chunked(mixed, ["_mix", id_column], "_position", size="_size")
    padded = F.ceil(F.col("_size") / shards) * shards
    places = F.sequence(F.col("_position"), padded - 1, F.col("_size"))
    return (
        numbered.withColumn("_place", F.explode(places))
        .withColumn("shard", (F.col("_place") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("_place") / shards))
        .drop("_mix", "_position", "_size", "_place")
    )


def focal_mean(
    cells: DataFrame, sweeps: int = 1, checkpoint_every: int = 4, tile: int = 64, per_exchange: int = 4
) -> DataFrame:
    """Replace each inner cell by the mean of its four neighbours, ``sweeps`` times.

    ``cells`` has (i, j, v, is_border), one row per cell; border cells keep
    their value. The grid is cut into square tiles. A single sweep shuffles
    each cell to its own tile, and cells on a tile's rim also to the tile next
    door; the sums over neighbours then need no further shuffle. Of more
    sweeps, ``per_exchange`` share a shuffle, for which the rim is as many
    cells wide. Long runs are cut by reliable checkpoints every
    ``checkpoint_every`` shuffles.
    """
    done = shuffles = 0
    while done < sweeps:
        now = min(per_exchange, sweeps - done)
        cells = _sweep(cells, tile) if now == 1 else _sweeps(cells, tile, now)
        done, shuffles = done + now, shuffles + 1
        if shuffles % checkpoint_every == 0 and done < sweeps:
            ensure_checkpoint_dir(cells.sparkSession)
            cells = cells.checkpoint()
    return cells


def _sweeps(cells: DataFrame, tile: int, sweeps: int) -> DataFrame:
    """Several sweeps after one shuffle: a tile comes with a rim ``sweeps`` cells wide.

    Each sweep is right one cell less far into the rim, and after the last one
    the tile itself still is. A task holds one tile with its rim as an array.
    """
    wide = tile + 2 * sweeps

    def along(c: str, name: str) -> Column:
        first, last = (F.floor((F.col(c) + d) / tile) for d in (-sweeps, sweeps))
        return F.explode(F.sequence(first, last)).alias(name)

    placed = cells.select("i", "j", "v", "is_border", along("i", "_ti")).select("*", along("j", "_tj"))

    def swept(table: pa.Table) -> pa.Table:
        corner = [table[t][0].as_py() * tile - sweeps for t in ("_ti", "_tj")]
        places = tuple(table[c].to_numpy() - start for c, start in zip("ij", corner))
        value, known, border, held = (np.zeros((wide + 2, wide + 2), k) for k in (float, bool, bool, bool))
        inner = tuple(p + 1 for p in places)
        value[inner] = table["v"].fill_null(0.0).to_numpy()
        known[inner], held[inner] = ~np.asarray(table["v"].is_null()), True
        border[inner] = table["is_border"].fill_null(False).to_numpy()
        moving = (held & ~border)[1:-1, 1:-1]
        for _ in range(sweeps):
            sides = [(slice(0, -2), slice(1, -1)), (slice(2, None), slice(1, -1)), (slice(1, -1), slice(0, -2)), (slice(1, -1), slice(2, None))]
            mean = sum(np.where(known[s], value[s], 0.0) for s in sides) * 0.25
            any_known = known[sides[0]] | known[sides[1]] | known[sides[2]] | known[sides[3]]
            value[1:-1, 1:-1], known[1:-1, 1:-1] = np.where(moving, mean, value[1:-1, 1:-1]), np.where(moving, any_known, known[1:-1, 1:-1])
        own = np.flatnonzero(np.all([(p >= sweeps) & (p < sweeps + tile) for p in places], axis=0))
        at = tuple(p[own] for p in inner)
        kept = table.select(["i", "j", "v", "is_border"]).take(own)
        return kept.set_column(2, "v", pa.array(value[at], pa.float64(), mask=~known[at]))

    shape = "i long, j long, v double, is_border boolean"
    typed = placed.select("_ti", "_tj", *[F.col(c).cast(k) for c, k in (x.split() for x in shape.split(", "))])
    return typed.groupBy("_ti", "_tj").applyInArrow(swept, shape)


def _tile_of(i: Column, j: Column, tile: int) -> Column:
    return F.struct(F.floor(i / tile).alias("_ti"), F.floor(j / tile).alias("_tj"))


def _sweep(cells: DataFrame, tile: int) -> DataFrame:
    i, j, v = F.col("i"), F.col("j"), F.col("v")
    sides = [(i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)]
    tiles = F.array_distinct(F.array(*[_tile_of(a, b, tile) for a, b in [(i, j), *sides]]))
    placed = cells.select("*", F.inline(tiles)).repartition("_ti", "_tj")

    nothing = F.lit(None)
    own = F.struct(i, j, nothing.cast("double").alias("part"), v.alias("own"), F.col("is_border"))
    sent = [
        F.struct(
            a.alias("i"), b.alias("j"), v.alias("part"),
            nothing.cast("double").alias("own"), nothing.cast("boolean").alias("is_border"),
        )
        for a, b in sides
    ]
    here = F.struct("_ti", "_tj")
    met = (
        placed.select("_ti", "_tj", F.inline(F.array(own, *sent)))
        .filter(_tile_of(F.col("i"), F.col("j"), tile) == here)
        .groupBy("_ti", "_tj", "i", "j")
        .agg(
            F.sum("part").alias("parts"),
            F.max("own").alias("own"),
            F.max("is_border").alias("is_border"),
        )
        # Values sent past the edge of the grid meet no cell.
        .filter(F.col("is_border").isNotNull())
    )
    mean = F.when(F.col("is_border"), F.col("own")).otherwise(F.col("parts") * 0.25)
    return met.select("i", "j", mean.alias("v"), "is_border")


def scaling_table(runs: DataFrame, case: str, workers: str, seconds: str) -> DataFrame:
    """Speed-up over the run with the fewest workers, and efficiency, per case."""
    first = Window.partitionBy(case).orderBy(workers)
    timed = runs.withColumn("_t1", F.first_value(seconds).over(first)).withColumn(
        "_p1", F.first_value(workers).over(first)
    )
    speedup = F.col("_t1") / F.col(seconds)
    return timed.select(
        case,
        workers,
        seconds,
        speedup.alias("speedup"),
        (speedup * F.col("_p1") / F.col(workers)).alias("efficiency"),
    )
