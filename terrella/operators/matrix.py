"""Dense matrices as tables of square tiles, and their product.

A tile is told line by line, so that no row, and no batch of rows, grows with
the tile or holds zeros: a row (row, col, line, data) is its place in the grid
of tiles, the line within the tile, and the cells of that line, ``at`` within it.
The product deals lines to output tiles: a column of a left tile is copied to
every output tile of its row that its inner place reaches, a line of a right
tile to every such output tile of its column. Inner places come in stretches of
bounded depth, each of which is one key. A task streams through its keys in
order, fills panels of one tile's width with the lines it meets, and holds two
panels and a tile at a time; products of a stretch are added up where they are
made, those of different stretches after one more shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.operators.partitions import keep

TILE = 256
#: Inner tiles of one stretch.
DEPTH = 64


def _line(at: str | Column) -> Column:
    """The cells of a line, in order."""
    return F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), "v")))


def to_tiles(cells: DataFrame, row: str, col: str, value: str, tile: int = TILE) -> DataFrame:
    """Tiles of a matrix given by its cells; cells of one place are added, absent and null ones are 0.

    Cells without row or column are left out. Lines without any cell have no row.
    """
    at = [F.col(c).cast("long") for c in (row, col)]
    placed = cells.select(at[0].alias("i"), at[1].alias("j"), F.col(value).cast("double").alias("v")).filter(
        "i IS NOT NULL AND j IS NOT NULL"
    )
    # One cell a place, so that a line gathers at most as many as the tile is wide.
    summed = placed.groupBy("i", "j").agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("v"))
    by = [F.floor(F.col(c) / tile).cast("long").alias(n) for c, n in (("i", "row"), ("j", "col"))]
    inner = [F.pmod(F.col(c), F.lit(tile)).cast("int").alias(n) for c, n in (("i", "line"), ("j", "_at"))]
    return summed.select(*by, *inner, "v").groupBy("row", "col", "line").agg(_line("_at").alias("data"))


def from_tiles(tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """Cells (i, j, v) of tiles that are not 0."""
    cells = tiles.select((F.col("row") * tile + F.col("line")).alias("i"), "col", F.inline("data"))
    return cells.select("i", (F.col("col") * tile + F.col("at")).alias("j"), "v").filter("v <> 0")


def _panel(lines: pa.ListArray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines under each other, without the places that none of them fills, and those places."""
    cells = lines.flatten()  # of this slice only
    at, v = (np.asarray(cells.field(n)) for n in ("at", "v"))
    line = np.repeat(np.arange(len(lines)), np.diff(lines.offsets.to_numpy()))
    used = np.zeros(tile, bool)
    used[at] = True
    panel = np.zeros((len(lines), np.count_nonzero(used)))
    panel[line, (np.cumsum(used) - 1)[at]] = v
    return panel, np.flatnonzero(used)


def multiply_tiles(a: DataFrame, b: DataFrame, tile: int = TILE, depth: int = DEPTH) -> DataFrame:
    """Tiles of the product of two tiled matrices; lines of zeros have no row.

    ``a`` and ``b`` have one row per line, as :func:`to_tiles` gives them. Each
    column of ``a`` and line of ``b`` within a tile is shuffled once per output
    tile in which it meets one of the other side.
    """
    cells = a.select("row", "col", F.col("line").alias("_line"), F.inline("data"))
    inner = (F.col("col") * tile + F.col("at")).alias("_k")
    left = cells.select("row", inner, "_line", "v").groupBy("row", "_k").agg(_line("_line").alias("left"))
    right = b.select((F.col("row") * tile + F.col("line")).alias("_k"), "col", F.col("data").alias("right"))
    # Lines are copied by the join, so that neither side may be broadcast by its estimated size.
    met = left.join(right.hint("merge"), "_k").withColumn("stretch", F.floor(F.col("_k") / (tile * depth)).cast("long"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def told() -> pa.RecordBatch:
            i, j = np.nonzero(total)
            columns = [pa.array(key[0] * tile + i), pa.array(key[1] * tile + j), pa.array(total[i, j])]
            return pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

        for batch in batches:
            keys = np.column_stack([np.asarray(batch[n]) for n in ("row", "col", "stretch")])
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                if (found := tuple(keys[start].tolist())) != key:
                    if key is not None:
                        yield told()
                    key, total = found, np.zeros((tile, tile))
                for cut in range(start, end, tile):
                    some = slice(cut, min(end, cut + tile))
                    (x, i), (y, j) = (_panel(batch[n][some], tile) for n in ("left", "right"))
                    total[np.ix_(i, j)] += x.T @ y
        if key is not None:
            yield told()

    keyed = met.select("row", "col", "stretch", "_k", "left", "right").repartition("row", "col", "stretch")
    dealt = keyed.sortWithinPartitions("row", "col", "stretch", "_k")
    return to_tiles(dealt.mapInArrow(over, "i long, j long, v double"), "i", "j", "v", tile)


def matmul_blocks(a: DataFrame, b: DataFrame, tile: int = TILE, depth: int = DEPTH) -> DataFrame:
    """Product of ``a(i, k, v)`` and ``b(k, j, v)`` by dense tiles: its cells (i, j, v) that are not 0."""
    left, right = keep(to_tiles(a, "i", "k", "v", tile), "tiles"), keep(to_tiles(b, "k", "j", "v", tile), "tiles")
    return from_tiles(multiply_tiles(left, right, tile, depth), tile)
