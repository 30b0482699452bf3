"""Ranked lexical search, term at a time, with a limited number of accumulators.

The queries' words are a dictionary that goes to every task, in blocks of
bounded size. One pass over the documents counts these words and keeps them as
(document, words, counts); aggregates give each word's number of documents and
the largest factor it has in any document, hence the most it can add to a score.

Tasks then score their documents in batches. For a query, its words come rarest
first. A word's documents get an accumulator each, until what the remaining
words can add at most is less than the k-th best score so far: no document
without an accumulator can then enter the result. The remaining words only
update the accumulators there are, exactly. Scores of a task's earlier batches
count as well, so that later batches make few accumulators. Tasks give their k
best documents of each query, and these are ranked in two steps.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrella.llm.common import map_batches, materialize, per_worker, prepare

#: Bytes of query texts in one block: bounds the dictionary that tasks hold.
BLOCK_BYTES = 4 << 20
#: Documents, and (document, word) pairs, that a task scores together.
BATCH_DOCS, BATCH_PAIRS = 16_384, 4_000_000
#: Ways in which a query's candidates are dealt before they are ranked as one.
SALTS = 64

#: Bytes that do not belong to a term become spaces, A-Z become small letters.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _counted(docs: DataFrame, words: list[bytes], label: str) -> DataFrame:
    """Documents with a term: (doc_id, n, words, counts), of the listed words only."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        number = per_worker((label, len(words)), lambda: {w: i for i, w in enumerate(words)})
        sizes, starts, found, counts = [], [0], [], []
        ids = batch.column("doc_id")
        for text in batch.column("text"):
            split = terms(text.as_py())
            sizes.append(len(split))
            held = Counter(map(number.get, split))
            held.pop(None, None)
            found.extend(held.keys())
            counts.extend(held.values())
            starts.append(len(found))
        offsets = pa.array(starts, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
            ],
            ["doc_id", "n", "words", "counts"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, count, "doc_id long, n long, words array<int>, counts array<int>").filter("n > 0")


def _factors(counted: DataFrame) -> tuple[DataFrame, int]:
    """Pairs as (doc_id, words, factors), and the number of documents.

    A factor is what a word's weight is multiplied by in a document.
    """
    totals = counted.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # As decimals: 90 n N does not fit into 64 bits on the largest tables.
    m = F.expr(
        f"10L + (CAST(n AS DECIMAL(18,0)) * CAST({90 * totals['docs']} AS DECIMAL(19,0))) "
        f"div CAST({max(totals['terms'], 1)} AS DECIMAL(19,0))"
    )
    factors = F.expr("transform(counts, tf -> (1000000000L * tf) div (1000L * tf + 8L * _m))")
    return counted.withColumn("_m", m).select("doc_id", "words", factors.alias("factors")), totals["docs"]


class _Best:
    """The k best (score, document) of one query so far: higher scores first, then lower ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def bar(self) -> int:
        """A score below this cannot enter any more."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]


def accumulate(
    query: Sequence[tuple[int, int, int]], lists: dict[int, tuple[np.ndarray, np.ndarray]], size: int, bar: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the k best of a query, and their scores.

    ``query`` lists (word, weight, bound) with the rarest word first, ``lists``
    the documents (0 to size) and factors of each word. ``bar`` is a score that
    a document must reach. Scores of the documents returned are exact; all others score
    less than ``bar`` or than k of those returned.
    """
    remaining = sum(bound for _, _, bound in query)
    scores = np.zeros(size, np.int64)
    open_, held = True, 0
    for word, weight, bound in query:
        if open_ and remaining < bar:
            open_ = False
            survivors = scores > 0
        if not open_ and not held:
            break
        remaining -= bound
        places, factors = lists.get(word, (None, None))
        if places is None:
            continue
        if open_:
            scores[places] += weight * factors
            held = int(np.count_nonzero(scores))
            if held >= k:
                bar = max(bar, int(np.partition(scores, size - k)[size - k]))
        else:
            kept = survivors[places]
            scores[places[kept]] += weight * factors[kept]
    found = np.flatnonzero(scores >= max(bar, 1))
    return found, scores[found]


def _inverted(words: np.ndarray, factors: np.ndarray, places: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(words, kind="stable")
    words, factors, places = words[order], factors[order], places[order]
    heads = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.empty(0, np.int64)
    ends = np.r_[heads[1:], len(words)]
    return {int(words[a]): (places[a:b], factors[a:b]) for a, b in zip(heads, ends)}


def _scored(pairs: DataFrame, queries: dict[int, list[tuple[int, int, int]]], k: int) -> DataFrame:
    """The k best documents of each query in each task: (query, doc_id, score)."""
    lowest = -(1 << 63)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q: _Best(k) for q in queries}
        waiting: list[tuple[np.ndarray, ...]] = []
        docs = held = 0

        def score() -> None:
            ids, lengths, words, factors = (np.concatenate(x) for x in zip(*waiting))
            lists = _inverted(words, factors, np.repeat(np.arange(len(ids)), lengths))
            for q, query in queries.items():
                found, scores = accumulate(query, lists, len(ids), best[q].bar(), k)
                if len(found):
                    best[q].add(scores, ids[found])

        for batch in batches:
            ids = batch.column("doc_id")
            column = batch.column("words")
            lengths = np.diff(column.offsets.to_numpy())
            waiting.append(
                (
                    ids.fill_null(lowest).to_numpy(zero_copy_only=False),
                    lengths,
                    column.flatten().to_numpy(),
                    batch.column("factors").flatten().to_numpy(),
                )
            )
            docs, held = docs + batch.num_rows, held + len(waiting[-1][2])
            if docs >= BATCH_DOCS or held >= BATCH_PAIRS:
                score()
                waiting, docs, held = [], 0, 0
        if waiting:
            score()
        rows = [(q, int(d), int(s)) for q, b in best.items() for d, s in zip(b.ids, b.scores)]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    found = pairs.mapInArrow(over, "query long, doc_id long, score long")
    return found.withColumn("doc_id", F.when(F.col("doc_id") != lowest, F.col("doc_id")))


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """Distinct words of the queries, (query, word), in blocks of queries of bounded size."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = -(-size // BLOCK_BYTES)
    dealt = items.withColumn("_block", F.pmod(F.xxhash64("_query"), F.lit(max(count, 1))))
    for block in range(count):
        rows = dealt.filter(F.col("_block") == block).select("_query", "text").collect()
        yield [(r["_query"], w) for r in rows for w in sorted(set(terms(r["text"])))]


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of every item: (item_id, rank, doc_id, score).

    Terms are runs of ASCII letters and digits and of characters beyond ASCII,
    A-Z in lower case. A term weighs floor(1000 ln((2N + 2) / (2 df + 1))), over
    N documents with a term of which df hold it; a document's factor for it is
    10^9 tf div (1000 tf + 8 m), with m = 10 + 90 n N div L for a document of n
    of all L terms. Only scores above 0 count; equal ones go by id, null first.

    Null or empty texts have no term: such documents are found by none and such
    items find none. Every row is a document or an item of its own, also where
    ids repeat or are null; further columns are not read and may have any name.
    ``doc_id`` is an integer. Empty tables give no rows.

    Query texts go to the tasks in blocks of about 4 MB, each of which reads the documents
    once; a single block is the rule.
    """
    prepare(docs.sparkSession)
    named = items.select("item_id", "text").withColumn("_query", F.monotonically_increasing_id())
    named = materialize(named, "items")
    result = None
    for block in _blocks(named):
        words = sorted({w for _, w in block})
        counted = materialize(_counted(docs, words, uuid.uuid4().hex), "counted")
        pairs, total = _factors(counted)
        used = pairs.select(F.inline(F.arrays_zip("words", "factors"))).groupBy("words")
        stats = used.agg(F.count("*").alias("df"), F.max("factors").alias("most"))
        weight = F.floor(1000 * F.log(F.lit(2 * total + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
        # As many rows as the block has words.
        known = {r["words"]: (r["df"], r["w"], r["w"] * r["most"]) for r in stats.withColumn("w", weight).collect()}
        place = {w: i for i, w in enumerate(words)}
        queries: dict[int, list] = {}
        for query, word in block:
            if place[word] in known:
                queries.setdefault(query, []).append((*known[place[word]], place[word]))
        rarest = {q: [(w, weight, bound) for _, weight, bound, w in sorted(found)] for q, found in queries.items()}
        scored = _scored(pairs, rarest, k)
        result = scored if result is None else result.unionByName(scored)
    if result is None:
        return named.sparkSession.createDataFrame([], named.select("item_id").schema.add("rank", "integer").add("doc_id", "long").add("score", "long"))
    order = [F.desc("score"), F.asc("doc_id")]
    salted = result.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    near = salted.withColumn("_place", F.row_number().over(Window.partitionBy("query", "_salt").orderBy(*order)))
    near = near.filter(F.col("_place") <= k).drop("_place", "_salt")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= k)
    return ranked.join(named, F.col("query") == F.col("_query")).select("item_id", "rank", "doc_id", "score")
