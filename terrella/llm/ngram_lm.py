"""A bigram language model in Elias-Fano tries, sharded over the cluster.

Documents form groups by a hash. Each group sends its distinct words and word
pairs, with their counts in training documents, to the shards that own them.
A shard adds up the counts of all groups and builds its trie: sorted context
hashes, monotone pointers to their ranges, and the words of each range relative
to their context, all Elias-Fano coded, with quantised counts beside them, in
one memory-mapped file. It answers the groups' requests from the trie by
context-relative successor search, and the groups score their documents. What
travels are distinct words and pairs of a group, so a frequent pair costs one
entry per group, and no machine ever holds the whole model. Continuations of
very frequent contexts are spread over shards.

The probability of word w after u is Dirichlet-smoothed,

    P(w | u) = (c(u w) + mu P1(w)) / (c(u) + mu),   P1(w) = (c(w) + 1) / (N + V + 1).
"""

from __future__ import annotations

import math
import tempfile
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import words_of

#: Weight of the unigram distribution, in tokens.
MU = 500.0
#: Bytes of text in a group, and bytes of text whose pairs one shard owns.
GROUP_BYTES, SHARD_BYTES = 9 << 20, 7 << 20
#: Documents sampled per shard to find contexts so frequent that their words are spread.
SAMPLE_PER_SHARD, SPREAD = 4, 256
#: Bits of a word's hash inside a context.
WORD_BITS = 40
#: Not words, as they are white space: the end of a text and the context of its first word.
END, START = b" ", b"\n"

REQUESTS = "kind int, shard int, g int, keys binary, sizes binary, words binary, counts binary"
ANSWERS = "kind int, shard int, g int, found binary, tokens bigint, types bigint"
SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


class EliasFano:
    """A sorted sequence: low bytes in planes, high bits in unary, to be searched by value."""

    def __init__(self, count: int, low_bytes: int, low: np.ndarray, high: np.ndarray):
        self.count, self.low_bytes, self.low, self.high = count, low_bytes, low, high
        bits = np.unpackbits(high, bitorder="little")
        zeros = np.flatnonzero(bits == 0)[: max(0, len(bits) - count)]
        # Elements whose high part is smaller than b stand before the b-th zero.
        self.starts = np.concatenate([[0], zeros - np.arange(len(zeros))]).clip(max=count)

    @staticmethod
    def encode(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        count = len(values)
        top = int(values[-1]) if count else 0
        low_bytes = max(0, math.ceil(math.log2(max(1, top / max(1, count))) / 8))
        low = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :low_bytes])
        high = (values >> np.uint64(8 * low_bytes)).astype(np.int64) if low_bytes < 8 else np.zeros(count, np.int64)
        bits = np.zeros((int(high[-1]) if count else 0) + count + 1, np.uint8)
        bits[high + np.arange(count)] = 1
        return count, low_bytes, low.reshape(-1), np.packbits(bits, bitorder="little")

    def _low(self, at: np.ndarray) -> np.ndarray:
        value = np.zeros(len(at), np.uint64)
        for k in range(self.low_bytes):
            value |= self.low[at * self.low_bytes + k].astype(np.uint64) << np.uint64(8 * k)
        return value

    def successor(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first element that is not smaller, and whether it is equal."""
        shift = np.uint64(8 * self.low_bytes)
        high = (queries >> shift).astype(np.int64) if self.low_bytes < 8 else np.zeros(len(queries), np.int64)
        low = queries & ((np.uint64(1) << shift) - np.uint64(1)) if self.low_bytes < 8 else queries
        last = len(self.starts) - 1
        at = np.asarray(self.starts[np.minimum(high, last)], np.int64)
        end = np.asarray(self.starts[np.minimum(high + 1, last)], np.int64)
        end = np.where(high + 1 > last, self.count, end)
        at = np.where(high > last, self.count, at)
        first, last = at, end.copy()
        going = np.flatnonzero(first < last)
        while len(going):  # binary search among the elements with the same high part
            middle = (first[going] + last[going]) >> 1
            smaller = self._low(middle) < low[going]
            first[going[smaller]] = middle[smaller] + 1
            last[going[~smaller]] = middle[~smaller]
            going = going[first[going] < last[going]]
        equal = np.zeros(len(queries), bool)
        inside = np.flatnonzero(first < end)
        equal[inside] = self._low(first[inside]) == low[inside]
        return first, equal


class Trie:
    """Contexts, pointers, words and values as memory-mapped levels of one file."""

    def __init__(self, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray, values: np.ndarray):
        """Sorted contexts, number of words of each, sorted words within each, and a value per word."""
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), sizes)
        relative = (rank << np.uint64(WORD_BITS)) | words
        pointers = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)
        levels = [EliasFano.encode(v) for v in (contexts, pointers, relative)]
        arrays = [x for level in levels for x in level[2:]] + [values]
        # The file has no name, so it goes when the task ends.
        with tempfile.TemporaryFile() as file:
            places = []
            for x in arrays:
                places.append((file.tell(), x.dtype, len(x)))
                file.write(x.tobytes() + bytes(8 - x.nbytes % 8))
            file.flush()
            mapped = np.memmap(file, np.uint8, "r")
        views = [mapped[at : at + n * t.itemsize].view(t) for at, t, n in places]
        self.contexts, self.pointers, self.words = (
            EliasFano(*level[:2], *views[2 * i : 2 * i + 2]) for i, level in enumerate(levels)
        )
        self.values = views[-1]
        # Each range's end, decoded for the search.
        self.ends = pointers[1:].astype(np.int64)

    def lookup(self, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Value of each word after its context, 0 if it was not seen."""
        rank, known = self.contexts.successor(contexts)
        rank, known = np.repeat(rank, sizes), np.repeat(known, sizes)
        found = np.zeros(len(words), self.values.dtype)
        asked = np.flatnonzero(known)
        query = (rank[asked].astype(np.uint64) << np.uint64(WORD_BITS)) | words[asked]
        at, equal = self.words.successor(query)
        hit = equal & (at < self.ends[rank[asked]])
        found[asked[hit]] = self.values[at[hit]]
        return found


#: Code of a count: itself up to 64, then in steps of about 9 %.
EXACT = 64


def quantise(counts: np.ndarray) -> np.ndarray:
    far = EXACT + np.round(np.log(np.maximum(counts, EXACT) / EXACT) / 0.09)
    return np.where(counts <= EXACT, counts, np.minimum(far, 255)).astype(np.uint8)


def restore(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.float64)
    return np.where(codes <= EXACT, codes, EXACT * np.exp((codes - EXACT) * 0.09))


def _narrow(counts: np.ndarray) -> bytes:
    kind = np.uint8 if not len(counts) or counts.max() < 256 else np.uint64
    return counts.astype(kind).tobytes()


def _wide(blob: bytes, count: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8 if len(blob) == count else np.uint64).astype(np.int64)


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Group:
    """Tokens of a group of documents, its distinct words and pairs, in the order of their shards."""

    def __init__(self, ids: list, texts: list, shards: int, spread: np.ndarray):
        from xxhash import xxh64_intdigest

        number: dict[bytes, int] = {START: 0, END: 1}
        lengths, tokens = [], []
        for text in texts:
            words = words_of(text)
            row = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
            tokens += [row, [1]]
            lengths.append(len(words) + 1)
        self.ids, self.lengths = ids, np.array(lengths, np.int64)
        token = np.concatenate(tokens).astype(np.int64)
        first = np.cumsum(self.lengths) - self.lengths
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[first] = 0
        self.held = np.array([i is None or crc32(str(i).encode()) % 7 == 2 for i in ids])
        trained = np.repeat(~self.held, self.lengths)
        hashes = np.array([xxh64_intdigest(w) for w in number], np.uint64)
        # Words, by hash.
        self.order = np.argsort(hashes)
        self.hashes, self.token = hashes[self.order], token
        self.counts = np.bincount(token[trained], minlength=len(number))[self.order]
        self.word_bounds = np.searchsorted(_shard_of(self.hashes, shards), np.arange(shards + 1))
        # Pairs, by shard, context and word inside the context.
        pair, self.inverse = np.unique(context * len(number) + token, return_inverse=True)
        counts = np.bincount(self.inverse[trained], minlength=len(pair))
        self.left, self.right = pair // len(number), pair % len(number)
        above, below = hashes[self.left], hashes[self.right]
        inner = below & np.uint64((1 << WORD_BITS) - 1)
        part = np.where(np.isin(above, spread), (below >> np.uint64(56)) + np.uint64(1), np.uint64(0))
        home = (above ^ (part * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        shard = _shard_of(home, shards)
        self.pair_order = np.lexsort((inner, above, shard))
        self.above, self.inner = above[self.pair_order], inner[self.pair_order]
        self.pair_counts = counts[self.pair_order]
        self.pair_bounds = np.searchsorted(shard[self.pair_order], np.arange(shards + 1))

    def requests(self, shards: int):
        """(kind, shard, keys, sizes, words, counts); every shard of words is asked, for its totals."""
        for s in range(shards):
            a, b = self.word_bounds[s : s + 2]
            yield 1, s, self.hashes[a:b].tobytes(), None, None, _narrow(self.counts[a:b])
            a, b = self.pair_bounds[s : s + 2]
            if a < b:
                above = self.above[a:b]
                new = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
                sizes = np.diff(np.append(new, b - a))
                words = self.inner[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : WORD_BITS // 8]
                yield 2, s, above[new].tobytes(), _narrow(sizes), words.tobytes(), _narrow(self.pair_counts[a:b])

    def scores(self, answers: list[tuple[int, int, bytes, int, int]], mu: float):
        """Columns of the result, from (kind, shard, found, tokens, types) of all shards."""
        total = sum(a[3] for a in answers if a[0] == 1)
        types = sum(a[4] for a in answers if a[0] == 1)
        by_kind = {1: [], 2: []}
        for kind, shard, found, _, _ in sorted(answers, key=lambda a: a[:2]):
            by_kind[kind].append(found)
        count = np.empty(len(self.hashes), np.int64)
        count[self.order] = np.frombuffer(b"".join(by_kind[1]), np.int64)
        seen = np.empty(len(self.left), np.float64)
        seen[self.pair_order] = restore(np.frombuffer(b"".join(by_kind[2]), np.uint8))
        mass = total + types + 1.0
        count[0] = count[1]  # as many starts as ends
        chance = (count + 1) / mass
        pair = np.log10((seen + mu * chance[self.right]) / (count[self.left] + mu))
        count[0] = 0
        first = np.cumsum(self.lengths) - self.lengths
        base = np.log10(count + 1.0)[self.token]
        return (
            self.ids,
            self.held,
            self.lengths,
            np.add.reduceat((count > 0)[self.token].astype(np.int64), first),
            np.full(len(first), total, np.int64),
            np.add.reduceat(base, first) - self.lengths * np.log10(mass),
            np.add.reduceat(pair[self.inverse], first),
        )


def _answer(kind: int, shard: int, rows: pa.Table):
    """Add up a shard's counts, build its trie and answer each group."""
    groups, counts = rows["g"].to_pylist(), []
    keys = [np.frombuffer(k, np.uint64) for k in rows["keys"].to_pylist()]
    if kind == 1:
        counts = [_wide(c, len(k)) for c, k in zip(rows["counts"].to_pylist(), keys)]
        words, at = np.unique(np.concatenate(keys), return_inverse=True)
        summed = np.bincount(at, np.concatenate(counts), len(words)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        found = np.split(summed[at], ends[:-1])
        # Bincount adds doubles, exact below 2^53.
        totals = int(summed.sum()), int((summed > 0).sum())
        return [(kind, shard, g, f.tobytes(), *totals) for g, f in zip(groups, found)]
    width = WORD_BITS // 8
    parts = []
    for k, sizes, words, c in zip(keys, *(rows[x].to_pylist() for x in ("sizes", "words", "counts"))):
        inner = np.zeros((len(words) // width, 8), np.uint8)
        inner[:, :width] = np.frombuffer(words, np.uint8).reshape(-1, width)
        parts.append((k, _wide(sizes, len(k)), inner.view("<u8").ravel().astype(np.uint64), _wide(c, len(inner))))
    above = np.concatenate([np.repeat(k, s) for k, s, _, _ in parts])
    inner = np.concatenate([w for _, _, w, _ in parts])
    count = np.concatenate([c for *_, c in parts])
    trained = count > 0  # only what training documents hold is in the model
    above, inner, count = above[trained], inner[trained], count[trained]
    order = np.lexsort((inner, above))
    above, inner, count = above[order], inner[order], count[order]
    fresh = np.ones(len(above), bool)
    fresh[1:] = (above[1:] != above[:-1]) | (inner[1:] != inner[:-1])
    new = np.flatnonzero(fresh)
    summed = np.add.reduceat(count, new) if len(new) else count
    contexts, sizes = np.unique(above[new], return_counts=True)
    trie = Trie(contexts, sizes, inner[new], quantise(summed))
    return [(kind, shard, g, trie.lookup(*p[:3]).tobytes(), 0, 0) for g, p in zip(groups, parts)]


def _spread_contexts(docs: DataFrame, shards: int) -> np.ndarray:
    """Hashes of words that hold more than a quarter of a shard's share in a sample; a few per shard at most."""
    from xxhash import xxh64_intdigest

    mixed = F.xxhash64("doc_id", F.lit("contexts"))
    sample = docs.orderBy(mixed, "doc_id").limit(SAMPLE_PER_SHARD * shards)
    words = sample.select(F.explode(F.split(F.substring("text", 1, 4000), r"[\x20\x09-\x0D]+")).alias("w"))
    words = words.select(F.translate("w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("w"))
    counted = words.groupBy("w").agg(F.count("*").alias("n"))
    total = words.count()
    often = counted.filter(F.col("n") > max(8, total / (4 * shards))).orderBy(F.desc("n")).limit(4 * shards)
    return np.array([xxh64_intdigest(r["w"].encode()) for r in often.collect()], np.uint64)


def score_documents(docs: DataFrame, mu: float = MU) -> DataFrame:
    """Base score and model score of every document.

    The model learns from documents whose crc32(doc_id) mod 7 is not 2; a null
    ``doc_id`` is held out. ``base_score`` is the add-one unigram score,
    ``score`` the bigram model's log10 probability; both count the end of the
    text as a token. A null text is empty and has that token only. Rows are
    scored one by one, so ids may repeat. Without training documents all counts
    are 0. Only ``doc_id`` and ``text`` are read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, shards = max(8, size // GROUP_BYTES), int(max(8, size // SHARD_BYTES))
    spread = _spread_contexts(docs, shards)
    mixed = F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    grouped = docs.select("doc_id", "text", mixed.alias("g"))
    table = lambda rows, schema, types: pa.table(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.replace(",", "").split()[::2]
    )
    small, blob, big = pa.int32(), pa.binary(), pa.int64()

    def ask(key, rows):
        group = Group(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), shards, spread)
        g = key[0].as_py()
        asked = [(kind, s, g, *blobs) for kind, s, *blobs in group.requests(shards)]
        return table(asked, REQUESTS, (small, small, small, blob, blob, blob, blob))

    def answer(key, rows):
        return table(_answer(key[0].as_py(), key[1].as_py(), rows), ANSWERS, (small, small, small, blob, big, big))

    def score(key, rows, answers):
        group = Group(rows["doc_id"].to_pylist(), rows["text"].to_pylist(), shards, spread)
        got = zip(*(answers[c].to_pylist() for c in ("kind", "shard", "found", "tokens", "types")))
        columns = group.scores(list(got), mu)
        types = (big, pa.bool_(), big, big, big, pa.float64(), pa.float64())
        names = SCORES.replace(",", "").split()[::2]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    requests = grouped.groupBy("g").applyInArrow(ask, REQUESTS)
    answers = requests.groupBy("kind", "shard").applyInArrow(answer, ANSWERS)
    return grouped.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(score, SCORES)
