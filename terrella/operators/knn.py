"""Exact k-nearest neighbours by Euclidean distance.

Every index row has to meet every query, so the work is a brute-force scan.
What can be kept small is the data that moves: each task keeps only its k best
rows per query, and only those reach the merge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrella.operators.partitions import keep

#: Queries are shipped to the tasks when their vectors take at most this many bytes.
QUERY_BYTES = 64 << 20
#: Passes run side by side, in one job, when their queries take at most this many bytes together.
ROUND_BYTES = 16 << 20
#: Queries per block otherwise.
QUERY_BLOCK = 4096
#: Index rows per block when both sides are blocked.
INDEX_BLOCK = 32_768
#: Queries and index rows compared at once inside a task.
_TILE_QUERIES = 128
_TILE_ROWS = 4096

_CANDIDATES = "query_id long, index_id long, distance double"
_NAMES = ["query_id", "index_id", "distance"]
_EMPTY = pa.table([pa.array([], kind) for kind in (pa.int64(), pa.int64(), pa.float64())], _NAMES)


class _Best:
    """The k best index rows seen so far for a few queries, in long form."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = (vectors * vectors).sum(axis=1)
        # |q - x|^2 = -2 q.x + |x|^2 + |q|^2 as one product of widened rows.
        self.wide = np.column_stack([-2.0 * vectors, np.ones(len(ids)), self.norms])
        self.limit = np.full(len(ids), np.inf)  # squared distance of the k-th best
        self.query = np.empty(0, np.int64)  # position in ``ids``
        self.index = np.empty(0, np.int64)
        self.distance = np.empty(0)

    def add(
        self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, wide: np.ndarray, asked: np.ndarray | slice = slice(None)
    ) -> None:
        """Meet index rows with the queries at the positions ``asked``."""
        rough = self.wide[asked] @ wide
        # The product form rounds; whatever rounding could have moved past the
        # k-th stays in, and its distance is then computed directly.
        slack = 1e-9 * (1.0 + self.norms[asked] + norms.max())
        near = rough <= (self.limit[asked] + slack)[:, None]
        if len(ids) > self.k and np.count_nonzero(near) > 16 * self.k * len(rough):
            bound = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1]
            near &= rough <= (bound + slack)[:, None]
        found = np.flatnonzero(near)  # far faster than by two axes
        if len(found) == 0:
            return
        query, row = np.divmod(found, len(ids))
        query = np.arange(len(self.ids))[asked][query]
        gaps = vectors[row] - self.vectors[query]
        self._merge(query, ids[row], np.sqrt((gaps * gaps).sum(axis=1)))

    def _merge(self, query: np.ndarray, index: np.ndarray, distance: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        index = np.concatenate([self.index, index])
        distance = np.concatenate([self.distance, distance])
        order = np.lexsort((index, distance, query))
        query, index, distance = query[order], index[order], distance[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        kept = rank < self.k
        self.query, self.index, self.distance = query[kept], index[kept], distance[kept]
        last = rank[kept] == self.k - 1
        self.limit[self.query[last]] = self.distance[last] ** 2


class _Search:
    """Best rows of all queries of a task, worked on tile by tile.

    A tile bounds the memory even when many rows are equally near.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        cuts = range(0, len(ids), _TILE_QUERIES)
        self.parts = [_Best(ids[c : c + _TILE_QUERIES], vectors[c : c + _TILE_QUERIES], k) for c in cuts]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for cut in range(0, len(ids), _TILE_ROWS):
            some, rows = ids[cut : cut + _TILE_ROWS], vectors[cut : cut + _TILE_ROWS]
            norms = (rows * rows).sum(axis=1)
            wide = np.column_stack([rows, norms, np.ones(len(some))]).T
            for part in self.parts:
                part.add(some, rows, norms, wide)

    def columns(self) -> list[pa.Array]:
        columns = [(part.ids[part.query], part.index, part.distance) for part in self.parts]
        return [pa.array(np.concatenate(column)) for column in zip(*columns)]


def nearest_pivot(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of the nearest pivot of each vector, and the distance to it."""
    gaps = (vectors * vectors).sum(axis=1)[:, None] - 2.0 * vectors @ pivots.T + (pivots * pivots).sum(axis=1)
    nearest = gaps.argmin(axis=1)
    return nearest, np.sqrt(((vectors - pivots[nearest]) ** 2).sum(axis=1))


class _PrunedSearch(_Search):
    """A search that leaves out cells of index rows too far from a pivot to matter.

    Rows of a batch are split into cells around a few of its own rows. By the
    triangle inequality no row of a cell is nearer to a query than the query's
    distance to the pivot less the cell's radius; a cell is skipped by queries
    whose k-th best is nearer than that. Where that would leave most pairs in, the rows are met as a whole.
    ``met`` and ``skipped`` count pairs of query and cell.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, cells: int):
        super().__init__(ids, vectors, k)
        self.cells, self.met, self.skipped = cells, 0, 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for cut in range(0, len(ids), _TILE_ROWS):
            some, rows = ids[cut : cut + _TILE_ROWS], vectors[cut : cut + _TILE_ROWS]
            pivots = rows[:: max(1, len(rows) // self.cells)][: self.cells]
            cell, gap = nearest_pivot(rows, pivots)
            members = [np.flatnonzero(cell == c) for c in range(len(pivots))]
            radius = np.array([gap[m].max(initial=0.0) for m in members])
            near = [rows[m] for m in members]
            norms = [(n * n).sum(axis=1) for n in near]
            wide = [np.column_stack([n, s, np.ones(len(n))]).T for n, s in zip(near, norms)]
            sizes = np.array([len(m) for m in members])
            whole = (rows * rows).sum(axis=1)
            all_wide = np.column_stack([rows, whole, np.ones(len(some))]).T
            for part in self.parts:
                apart = np.sqrt(((part.vectors[:, None, :] - pivots[None]) ** 2).sum(axis=2))
                lowest = np.maximum(apart - radius, 0.0) * (1 - 1e-9)
                if np.isfinite(part.limit).all() and 2 * ((lowest**2 <= part.limit[:, None]) @ sizes).sum() > len(lowest) * len(rows):
                    self.met += lowest.size
                    part.add(some, rows, whole, all_wide)
                    continue
                # Nearest cells first, as they bring the limit down.
                for c in np.argsort(lowest.min(axis=0), kind="stable"):
                    if not len(members[c]):
                        continue
                    asked = np.flatnonzero(lowest[:, c] ** 2 <= part.limit)
                    self.met, self.skipped = self.met + len(lowest), self.skipped + len(lowest) - len(asked)
                    if len(asked):
                        part.add(some[members[c]], near[c], norms[c], wide[c], asked)


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists as one matrix; other lengths are an error."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = pc.unique(pc.list_value_length(vectors))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths.to_pylist())}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _ids(ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(ids, dtype=np.int64)


def _as_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull())


def _scan_with_queries(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """One pass over the index with all queries in each task."""
    table = queries.toArrow()
    if table.num_rows == 0:
        return index.sparkSession.createDataFrame([], _CANDIDATES)
    shipped = index.sparkSession.sparkContext.broadcast((_ids(table["id"]), _matrix(table["v"])))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Search(*shipped.value, k)
        for batch in batches:
            if batch.num_rows:
                best.add(_ids(batch["id"]), _matrix(batch["v"]))
        yield pa.RecordBatch.from_arrays(best.columns(), _NAMES)

    return index.mapInArrow(scan, _CANDIDATES)


def _block_by_block(index: DataFrame, queries: DataFrame, k: int, index_rows: int, query_rows: int) -> DataFrame:
    """Blocks of the index against blocks of the queries, one pair per task group.

    Ids are hashed into blocks, so the blocks are even. The index is copied
    once per query block and the queries once per index block.
    """
    index_blocks = max(1, math.ceil(index_rows / INDEX_BLOCK))
    query_blocks = max(1, math.ceil(query_rows / QUERY_BLOCK))

    def block(count: int):
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = index.select("id", "v", block(index_blocks).alias("ib"), every(query_blocks).alias("qb"))
    right = queries.select("id", "v", every(index_blocks).alias("ib"), block(query_blocks).alias("qb"))

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or asked.num_rows == 0:
            return _EMPTY
        best = _Search(_ids(asked["id"]), _matrix(asked["v"]), k)
        best.add(_ids(rows["id"]), _matrix(rows["v"]))
        return pa.table(best.columns(), _NAMES)

    return left.groupBy("ib", "qb").cogroup(right.groupBy("ib", "qb")).applyInArrow(meet, _CANDIDATES)


def k_nearest_in_passes(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector: str = "embedding",
    pass_bytes: int = QUERY_BYTES,
    cells: int = 16,
) -> DataFrame:
    """The same as :func:`k_nearest` for many queries: the index stays where it is and is read by every pass.

    A pass has queries of about ``pass_bytes``. As many passes as :data:`ROUND_BYTES` holds make a round, which is one
    job: its passes are dealt to as many scans of the index as there are cores, so that they run side by side however
    few files the index has. A task keeps a running top k of its scan's queries
    and prunes its rows by cells around pivots; a round's result is written to the
    shared folder, so that a round that is done is not run again. Pruning helps
    most where rows of one file are alike, as :func:`near_each_other` lays them.
    """
    index, queries = _as_vectors(index, id_column, vector), _as_vectors(queries, id_column, vector)
    rows, width = queries.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    passes = max(1, math.ceil(rows * width * 8 / pass_bytes))
    together = max(1, ROUND_BYTES // pass_bytes)
    context = index.sparkSession.sparkContext
    numbered = queries.withColumn("_pass", F.pmod(F.xxhash64("id"), F.lit(passes)))
    found = None
    for first in range(0, passes, together):
        last = min(passes, first + together) - 1
        table = numbered.filter(F.col("_pass").between(first, last)).toArrow()
        if not table.num_rows:
            continue
        scans = min(last + 1 - first, context.defaultParallelism)
        share, ids, vectors = _ids(table["_pass"]) % scans, _ids(table["id"]), _matrix(table["v"])
        shipped = [context.broadcast((ids[share == s], vectors[share == s])) for s in np.unique(share)]
        candidates = reduce(DataFrame.unionByName, [index.mapInArrow(_pruned_scan(some, k, cells), _CANDIDATES) for some in shipped])
        done = keep(_ranked(candidates, k), "knn-round")
        for some in shipped:
            some.destroy()
        found = done if found is None else found.unionByName(done)
    if found is None:
        found = _ranked(index.sparkSession.createDataFrame([], _CANDIDATES), k)
    return found


def _pruned_scan(shipped, k: int, cells: int):
    """A function on the batches of a partition that finds the best of its rows for the shipped queries."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _PrunedSearch(*shipped.value, k, cells)
        for batch in batches:
            if batch.num_rows:
                best.add(_ids(batch["id"]), _matrix(batch["v"]))
        yield pa.RecordBatch.from_arrays(best.columns(), _NAMES)

    return scan


def near_each_other(index: DataFrame, vector: str = "embedding", pivots: int = 256, seed: int = 17) -> DataFrame:
    """An index laid out so that near vectors share a partition: a shuffle to pay once, before it is written.

    Pivots are the rows with the lowest hashes, and each row goes to the nearest
    one. A pivot with many rows is cut over several partitions. Rows without vector come last.
    """
    drawn = index.filter(F.col(vector).isNotNull()).select(F.col(vector).alias("v"))
    found = drawn.withColumn("_h", F.xxhash64(F.lit(seed), "v")).orderBy("_h").limit(pivots).select("v").toArrow()
    if not found.num_rows:
        return index
    centers = _matrix(found["v"])

    @F.pandas_udf("int")
    def nearest(rows: pd.Series) -> pd.Series:
        held = [i for i, r in enumerate(rows) if r is not None]
        out = np.full(len(rows), len(centers))
        if held:
            out[held] = nearest_pivot(np.stack(rows.iloc[held].to_list()).astype(np.float64), centers)[0]
        return pd.Series(out)

    placed = index.withColumn("_pivot", nearest(vector)).withColumn("_spread", F.xxhash64(vector))
    return placed.repartitionByRange("_pivot", "_spread").sortWithinPartitions("_pivot").drop("_pivot", "_spread")


def k_nearest(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector: str = "embedding",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """The k nearest index rows of each query: (query_id, rank, index_id, distance).

    Ranks start at 1; equal distances go to the smaller id. Rows without id or
    vector are left out, and so are distances that are no number.
    Queries above the byte bound are never collected: both sides are blocked.
    """
    index, queries = _as_vectors(index, id_column, vector), _as_vectors(queries, id_column, vector)
    rows, width = queries.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if rows * width * 8 <= query_bytes:
        candidates = _scan_with_queries(index, queries, k)
    else:
        candidates = _block_by_block(index, queries, k, index.count(), rows)
    return _ranked(candidates, k)


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy("distance", "index_id")
    return (
        candidates.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "index_id", "distance")
    )
