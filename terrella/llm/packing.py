"""Best-fit packing of token sequences by bulk-synchronous sweeps.

Documents become pieces of at most ``capacity`` tokens. Sorted by length, the
pieces form runs of equal length, and so do the gaps of the open sequences; both
run tables have at most ``capacity`` rows however many documents there are.
A sweep walks the sorted runs, finds for each the successor among the gaps (the
smallest gap that holds it), settles conflicts by rank (longer pieces first,
then lower rank) and updates the gaps. Sweeps repeat until no gap holds a
waiting piece; then sequences are opened for the longest ones. The sweeps write
a plan of rank intervals; every piece finds its place by its rank within its
length, which Spark computes and joins.
"""

from __future__ import annotations

import json
from collections import deque
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrella.llm.common import map_batches, materialize, per_worker

#: Pieces of one length that a task ranks.
RANK_ROWS = 1_000_000
#: Words whose ids a worker remembers.
CACHED_WORDS = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Words(dict):
    """Word to the ids of a space and the word, as little-endian bytes.

    Only words without white space at their ends are kept: text made of such
    words between single spaces can be encoded word by word, as the tokenizer
    never joins over a space that follows a visible character.
    """

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise KeyError(word)
        ids = np.array(self.encode(" " + word), dtype="<u4").tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """Ids of a byte-level BPE vocabulary given as a tokenizers file.

    Texts that hold the string of a special token, or odd white space, go to
    the tokenizers library itself; the rest is encoded word by word with the
    same vocabulary and pattern.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        described = json.loads(Path(path).read_text(encoding="utf-8"))
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        to_byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(to_byte[c] for c in token): i
            for token, i in described["model"]["vocab"].items()
            if token not in self.special
        }
        self.fast = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self.fast.encode_ordinary)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        first, *rest = text.split(" ")
        try:
            if first and first[-1].isspace():
                raise KeyError(first)
            encoded = b"".join(map(self.words.__getitem__, rest))
        except KeyError:
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.concatenate(
            [np.array(self.fast.encode_ordinary(first), dtype="<u4"), np.frombuffer(encoded, "<u4")]
        )


def token_pieces(
    docs: DataFrame, tokenizer: str, pattern: str, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Cut every document's ids, closed by ``end_id``, into pieces.

    A null text counts as empty and gives one piece, the end. Only the first
    piece of a document can be shorter than ``capacity``. Nothing but ``doc_id``
    and ``text`` is read; a null or repeated ``doc_id`` is kept as it is.
    """

    def cut(batch: pa.RecordBatch):
        from zlib import crc32

        encoder = per_worker(("encoder", tokenizer, pattern), lambda: Encoder(tokenizer, pattern))
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            ids = np.append(encoder.ids(text.as_py()), np.array([end_id], "<u4")).astype("<u4")
            count = -(-len(ids) // capacity)
            end = len(ids) - (count - 1) * capacity
            start = 0
            for piece in range(count):
                rows.append((doc_id, piece, start, end - start, crc32(ids[start:end].tobytes())))
                start, end = end, end + capacity
        columns = list(zip(*rows))
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return map_batches(docs.select("doc_id", "text"), cut, PIECES)


class _Gaps:
    """Open sequences by the size of their gap, as intervals of sequence numbers."""

    def __init__(self, capacity: int):
        self.count = np.zeros(capacity + 1, np.int64)
        self.intervals = [deque() for _ in range(capacity + 1)]

    def put(self, size: int, first: int, count: int) -> None:
        if size and count:
            self.count[size] += count
            self.intervals[size].append((first, count))

    def take(self, size: int, count: int):
        self.count[size] -= count
        while count:
            first, n = self.intervals[size].popleft()
            used = min(n, count)
            if used < n:
                self.intervals[size].appendleft((first + used, n - used))
            yield first, used
            count -= used


def plan_packing(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rank intervals (length, first_rank, end_rank, first_sequence, per_sequence, offset).

    ``lengths`` counts the pieces of each length. The piece of rank r goes to
    sequence first_sequence + (r - first_rank) div per_sequence. The number of
    intervals depends on ``capacity`` alone.
    """
    size = np.array(sorted(lengths, reverse=True), np.int64)
    left = np.array([lengths[s] for s in size], np.int64)
    rank = np.zeros(len(size), np.int64)
    gaps, opened, plan = _Gaps(capacity), 0, []

    def place(i: int, gap: int, sequences: int, each: int) -> None:
        """Put ``each`` pieces of run i into each of some sequences with this gap."""
        for first, n in gaps.take(gap, sequences):
            end = int(rank[i]) + n * each
            plan.append((int(size[i]), int(rank[i]), end, first, each, capacity - gap))
            gaps.put(gap - each * int(size[i]), first, n)
            left[i] -= n * each
            rank[i] = end

    while left.any():
        # A sweep: the successor of each waiting run among the gaps.
        held = np.flatnonzero(gaps.count)
        waiting = np.flatnonzero(left)
        at = np.searchsorted(held, size[waiting])
        if not len(held) or (at == len(held)).all():
            longest = size[waiting[0]]
            band = waiting[size[waiting] > longest // 2]
            new = int(left[band][size[band] * 2 > capacity].sum())
            short = band[size[band] * 2 <= capacity]
            new = new or int(-(-(size[short] * left[short]).sum() // capacity))
            gaps.put(capacity, opened, new)
            opened += new
            continue
        for i, k in zip(waiting, at):  # longer runs come first and win
            if k == len(held) or not gaps.count[held[k]]:
                continue  # lost to a longer piece: it asks again in the next sweep
            gap, each = int(held[k]), int(held[k] // size[i])
            full = min(int(gaps.count[gap]), int(left[i] // each))
            if full:
                place(i, gap, full, each)
            if 0 < left[i] < each and gaps.count[gap]:
                place(i, gap, 1, int(left[i]))
    return plan


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` up to ``capacity``.

    ``pieces`` needs the columns of :func:`token_pieces`; others are kept. Equal
    rows are interchangeable. Pieces are ranked within their length in chunks
    spread by a hash, so that a length shared by most pieces is no large task.
    An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_packing(counted, capacity),
        "length bigint, _from bigint, _to bigint, _first bigint, _each bigint, _offset bigint",
    )
    chunks = max(16, -(-sum(counted.values()) // RANK_ROWS))
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    chunked = pieces.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    sums = chunked.groupBy("length", "_chunk").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_chunk").orderBy(*order)) - 1
    ranked = chunked.withColumn("_inside", inside).join(sums, ["length", "_chunk"])
    ranked = ranked.withColumn("_rank", F.col("_inside") + F.col("_before"))
    # The plan's size is bounded by the capacity, whatever the number of pieces.
    found = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    place = F.col("_rank") - F.col("_from")
    return found.select(
        *pieces.columns,
        (F.col("_first") + F.floor(place / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (place % F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = 2048) -> DataFrame:
    """Pieces of all documents with their place; the pieces are kept in the shared folder."""
    return pack(materialize(token_pieces(docs, tokenizer, pattern, capacity), "pieces"), capacity)
