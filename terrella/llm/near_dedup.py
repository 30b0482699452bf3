"""Near-duplicate groups by MinHash banding and sequential Bayesian verification.

1. Every document becomes its set of distinct word shingles, a digest of that
   set, MinHash values in bands and one byte of each value. Equal sets form a
   class; only its document of least id goes on.
2. Documents with an equal band meet in a bucket. Each is compared with the
   bucket's hub, its least id: one pair per document and bucket, never all.
3. A pair is compared batch by batch of signature bytes and dropped as soon as
   the posterior probability that it reaches the threshold falls below
   ``MISS``; survivors are verified on their whole shingle sets.
4. Verified links give components. In buckets that still hold several
   components and three or more documents, members of different components are
   compared, block against block of at most ``BLOCK`` rows, with the same
   pruning and verification. This finds links that miss the hub.

With 64 bands of 6 rows a pair at similarity 0.75 shares no band with
probability 4e-6, and less above.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import map_batches, materialize, words_of

BANDS, ROWS = 64, 6
#: Signature bytes compared before the next decision.
BATCH = 32
#: Posterior probability of reaching the threshold below which a pair is dropped.
MISS = 1e-6
#: Members of a bucket that are compared in one task with as many others.
BLOCK = 512
#: Ids that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

SKETCH = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature binary, bands array<bigint>"


class _Hashes(dict):
    """64-bit hash of each word seen."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        value = xxh64_intdigest(word)
        if len(self) < 500_000:
            self[word] = value
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words.

    A shorter text is one shingle as a whole; a text without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    at = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(width, len(at))
    runs = np.full(len(at) - span + 1, span, np.uint64)
    for j in range(span):
        runs = _mixed(runs + at[j : j + len(runs)])
    return np.unique(runs)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(0, 2**32, count, np.uint32) | np.uint32(1), rng.integers(0, 2**32, count, np.uint32)


def minhash(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Least value of each permutation over a set, in blocks of bounded size."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 1024):
        block = short[start : start + 1024, None] * factors
        block ^= shifts
        np.minimum(best, block.min(axis=0), out=best)
    return best


def sketch(docs: DataFrame, width: int = 5) -> DataFrame:
    """Set size, digest, signature and band keys of every document; none of these for an empty set."""

    def sketched(batch: pa.RecordBatch):
        from hashlib import blake2b

        factors, shifts = permutations(BANDS * ROWS)
        hashes, rows = _Hashes(), []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            shingles = shingle_set(text.as_py(), width, hashes)
            if not len(shingles):
                rows.append((doc_id, 0, None, None, None, None))
                continue
            digest = np.frombuffer(blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)
            values = minhash(shingles, factors, shifts)
            keys = np.arange(BANDS, dtype=np.uint64)
            for column in values.reshape(BANDS, ROWS).T:
                keys = _mixed(keys + column.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            signature = (values ^ (values >> np.uint32(13))).astype(np.uint8).tobytes()
            rows.append((doc_id, len(shingles), int(digest[0]), int(digest[1]), signature, keys.view(np.int64)))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        names = ["doc_id", "n_shingles", "k1", "k2", "signature", "bands"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return map_batches(docs.select("doc_id", "text"), sketched, SKETCH)


def least_matches(threshold: float, size: int = BANDS * ROWS, miss: float = MISS) -> list[int]:
    """After each batch, the fewest equal bytes with which a pair goes on.

    With a uniform prior, m of n matches leave the probability P(Bin(n + 1, t)
    <= m) that the rate of matches is at least t; unequal values agree in their
    byte once in 256 times.
    """
    rate = threshold + (1 - threshold) / 256
    fewest = []
    for n in range(BATCH, size + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * rate**m * (1 - rate) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        fewest.append(m)
    return fewest


def survive(left: np.ndarray, right: np.ndarray, fewest: list[int]) -> np.ndarray:
    """Rows of two signature matrices whose pairs survive all batches."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, least in enumerate(fewest):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches += (left[alive, part] == right[alive, part]).sum(axis=1)
        stays = matches >= least
        alive, matches = alive[stays], matches[stays]
    return alive


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def _surviving_pairs(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures leave the threshold possible."""
    fewest = least_matches(threshold)

    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        kept = np.zeros(len(a), bool)
        if len(a):
            kept[survive(_matrix(a), _matrix(b), fewest)] = True
        return pd.Series(kept)

    left = signatures.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(right, "b").join(left, "a").filter(passes("sa", "sb")).select("a", "b")


def _whole_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, members): the sorted shingle set of each document in ``ids``."""
    ids = materialize(ids, "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def collected(batch: pa.RecordBatch):
        hashes = _Hashes()
        sets = [shingle_set(t, width, hashes).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sets, pa.binary())], names=["doc_id", "members"])

    chosen = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    sets = map_batches(chosen, collected, "doc_id bigint, members binary")
    return materialize(sets, "shingles").groupBy("doc_id").agg(F.min("members").alias("members"))


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``percent`` / 100."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, docs: DataFrame, threshold: float, width: int) -> DataFrame:
    """Pairs whose whole shingle sets reach the threshold."""
    pairs = materialize(pairs, "survivors")
    sets = _whole_sets(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), width)
    percent = round(100 * threshold)

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        read = lambda x: np.frombuffer(x, np.uint64)
        return pd.Series([reaches(read(x), read(y), percent) for x, y in zip(a, b)], dtype=bool)

    left = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("mb"))
    return pairs.join(right, "b").join(left, "a").filter(linked("ma", "mb")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, label) of every linked document; the label is the least id reachable.

    Labels move along links and jump to the label of their label, so the number
    of rounds grows with the logarithm of the longest path.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = materialize(edges.union(edges.select("v", "u")).distinct(), "edges")
    labels = edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("label")).withColumnRenamed("u", "doc_id")
    labels = materialize(labels, "labels")
    while True:
        near = edges.join(labels.select(F.col("doc_id").alias("v"), "label"), "v")
        near = near.groupBy(F.col("u").alias("doc_id")).agg(F.min("label").alias("_near"))
        moved = labels.join(near, "doc_id").select(
            "doc_id", F.col("label").alias("_old"), F.least("label", "_near").alias("_new")
        )
        jump = labels.select(F.col("doc_id").alias("_new"), F.col("label").alias("_next"))
        moved = moved.join(jump, "_new").select("doc_id", "_old", F.least("_new", "_next").alias("label"))
        moved = materialize(moved, "labels")
        if moved.filter("_old <> label").isEmpty():
            return moved.select("doc_id", "label")
        labels = moved.select("doc_id", "label")


def _across(members: DataFrame, threshold: float) -> DataFrame:
    """Links between labels inside buckets (key, c, doc_id, label, signature, members).

    A bucket of more than ``BLOCK`` members is cut into blocks, and every pair
    of blocks is a group of its own. Survivors of the signatures are verified on
    their whole sets at once. Labels that a link joins are not compared again,
    so a group gives fewer links than it has members.
    """
    fewest, percent = least_matches(threshold), round(100 * threshold)
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    placed = members.withColumn("_blocks", blocks).withColumn(
        "_block", F.pmod(F.xxhash64("doc_id", "key"), F.col("_blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    placed = placed.withColumn("_other", other).select(
        "key", "doc_id", "label", "signature", "members", "_block",
        F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"),
    )

    def compare(key, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        ids, signature = rows["doc_id"].to_numpy(), _matrix(rows["signature"])
        sets = [np.frombuffer(m, np.uint64) for m in rows["members"]]
        root, block = rows["label"].to_numpy().copy(), rows["_block"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        for x in left:
            y = right[(root[right] != root[x]) & ((ids[right] > ids[x]) | (i != j))]
            if not len(y):
                continue
            for k in y[survive(np.broadcast_to(signature[x], (len(y), signature.shape[1])), signature[y], fewest)]:
                if root[k] != root[x] and reaches(sets[x], sets[k], percent):
                    found.append((min(ids[x], ids[k]), max(ids[x], ids[k])))
                    root[root == root[k]] = root[x]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return placed.groupBy("key", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.75, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked when their sets of distinct ``width``-word shingles
    have a Jaccard similarity of at least ``threshold``. ``component_id`` is the
    least id reachable over links, ``kept`` whether that is the document
    itself. A null or empty text has no shingles and is linked with nothing. A
    null ``doc_id`` takes the component of a document with the same set, or
    none and is then kept. Rows that share an id share their links. Only
    ``doc_id`` and ``text`` are read.
    """
    sketched = materialize(sketch(docs, width), "sketches")
    filled = sketched.filter("n_shingles > 0")
    classes = filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    leaders = classes.filter("rep is not null").select(F.col("rep").alias("doc_id"))
    first = materialize(filled.join(leaders, "doc_id", "left_semi").dropDuplicates(["doc_id", "k1", "k2"]), "leaders")
    signatures = first.groupBy("doc_id").agg(F.min("signature").alias("signature"))
    banded = first.select("doc_id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("c")).filter("c > 1")
    met = materialize(banded.join(buckets, "key"), "buckets")
    stars = met.filter("doc_id > hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = materialize(_verified(_surviving_pairs(stars, signatures, threshold), docs, threshold, width), "links")
    labels = components(links)
    labelled = met.filter("c > 2").join(labels, "doc_id", "left").withColumn(
        "label", F.coalesce("label", "doc_id")
    )
    span = labelled.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo < _hi")
    mixed = labelled.join(span.select("key"), "key", "left_semi").join(signatures, "doc_id")
    mixed = materialize(mixed.select("key", "c", "doc_id", "label", "signature"), "mixed")
    sets = _whole_sets(docs, mixed.select("doc_id").distinct(), width)
    more = materialize(_across(mixed.join(sets, "doc_id"), threshold), "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    labels = labels.withColumnRenamed("doc_id", "rep")
    grouped = classes.join(labels, "rep", "left").select("k1", "k2", F.coalesce("label", "rep").alias("_component"))
    found = sketched.select("doc_id", "n_shingles", "k1", "k2").join(grouped, ["k1", "k2"], "left")
    component = F.coalesce("_component", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
