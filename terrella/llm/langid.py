"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton of a bounded labelled sample recognises
every substring of the sample. A text is parsed greedily into the longest
phrases that occur in the sample; the fewer phrases a language needs, after
normalising by the lengths of text and sample (Ziv and Merhav's cross-parsing
entropy in bits per character), the closer the text is to it.

The sample holds at most ``rows`` slices of ``chars`` code points per language,
picked by a hash of the id, so automata have a fixed size. Texts are parsed
whole: they are cut into blocks that all advance together, one character a
step, through one transition table of all languages.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrella.llm.common import map_batches, one_of_three

#: Slices per language and code points per slice that the automata are built from.
SAMPLE_ROWS, SAMPLE_CHARS = 32, 512
#: Symbols: 0 for anything but letters, frequent letters of the sample, and buckets for all other letters.
LETTERS, BUCKETS = 40, 8
#: Code points of a block; blocks advance together.
BLOCK = 256
UNDETERMINED = "und"

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_char double"


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring; state 0 is the root."""
    moves, links, lengths, last = [{}], [-1], [0], 0
    for c in symbols.tolist():
        new = len(moves)
        moves.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = links[at]
        if at >= 0:
            to = moves[at][c]
            if lengths[to] == lengths[at] + 1:
                links[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                links.append(links[to])
                lengths.append(lengths[at] + 1)
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = copy
                    at = links[at]
                links[to] = links[new] = copy
        last = new
    return moves


class CrossParser:
    """Transition table over all languages, and the symbol of every code point."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        letters = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
        self.symbol = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            if chr(point).isalpha():
                self.symbol[point] = 1 + LETTERS + point % BUCKETS
        for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]):
            self.symbol[ord(c)] = 1 + i
        self.pad = 1 + LETTERS + BUCKETS
        self.width = self.pad + 1
        tables, self.roots, self.bits, states = [], [], [], 0
        for language in self.languages:
            parts = [self.symbols(t) for t in samples[language]]
            joined = np.concatenate([x for p in parts for x in (p, [0])]).astype(np.uint8)
            moves = suffix_automaton(joined)
            table = np.empty((len(moves), self.width), np.int64)
            offsets = (states + np.arange(len(moves))) * self.width
            # A missing transition ends the phrase (lowest bit) and starts the next one with this symbol.
            table[:] = offsets[0] << 1 | 1
            for c, to in moves[0].items():
                table[:, c] = offsets[to] << 1 | 1
            for state, out in enumerate(moves):
                for c, to in out.items():
                    table[state, c] = offsets[to] << 1
            table[:, self.pad] = offsets << 1
            tables.append(table.astype(np.int32))
            self.roots.append(int(offsets[0]))
            self.bits.append(math.log2(max(2, len(joined))))
            states += len(moves)
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text in lower case; runs of anything but letters count as one."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.symbol[points]
        if len(found):
            keep = found != 0
            keep[1:] |= found[:-1] != 0
            found = found[keep]
        return found

    def bits_per_symbol(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-parsing entropy, one row per text and one column per language."""
        blocks = np.array([-(-len(t) // BLOCK) for t in texts])
        lanes = np.full((int(blocks.sum()), BLOCK), self.pad, np.uint8)
        first = np.cumsum(blocks) - blocks
        flat = lanes.reshape(-1)
        for t, at in zip(texts, first):
            flat[at * BLOCK : at * BLOCK + len(t)] = t
        steps = np.ascontiguousarray(lanes.T)
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(lanes), axis=1)
        phrases = np.ones(state.shape, np.int32)
        for step in steps:
            moved = self.table[state + step]
            phrases += moved & 1
            state = moved >> 1
        owner = np.repeat(np.arange(len(texts)), blocks)
        size = np.maximum(1, [len(t) for t in texts])
        return np.stack(
            [np.bincount(owner, p, len(texts)) * b / size for p, b in zip(phrases, self.bits)], axis=1
        )

    def identify(self, texts: list[str | None]):
        """(language, score, bits per symbol) of each text.

        The score is the share by which the best language beats the second: 0
        in a tie, which the first language by name wins, 1 if there is but one.
        """
        symbols = [self.symbols(t) if t else np.empty(0, np.uint8) for t in texts]
        known = [i for i, s in enumerate(symbols) if s.any()] if self.languages else []
        out = [(UNDETERMINED, 0.0, None)] * len(texts)
        if known:
            bits = self.bits_per_symbol([symbols[i] for i in known])
            order = np.argsort(bits, axis=1, kind="stable")
            for row, i in enumerate(known):
                best = bits[row, order[row, 0]]
                score = 1.0 - best / bits[row, order[row, 1]] if len(self.languages) > 1 else 1.0
                out[i] = (self.languages[order[row, 0]], float(min(1.0, max(0.0, score))), float(best))
        return out


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> CrossParser:
    """Automata of the labelled documents whose crc32(doc_id) mod 3 is not 1.

    Each language gives its ``rows`` documents of least hash, one slice of
    ``chars`` code points each, taken at a place that the hash picks.
    """
    mixed = F.xxhash64("doc_id", F.lit("language sample"))
    learned = docs.select("doc_id", "text", "lang").filter(
        (one_of_three("doc_id", 3) != 1) & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - chars + 1)) + 1
    sliced = learned.select("lang", mixed.alias("_h"), F.substring("text", start.cast("int"), F.lit(chars)).alias("t"))
    best = Window.partitionBy("lang").orderBy("_h", "t")
    picked = sliced.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= rows)
    samples: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "_h", "t").collect():  # rows x chars per language
        samples.setdefault(row["lang"], []).append(row["t"])
    return CrossParser(samples)


def identify_language(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Predicted language of every document.

    ``und`` with score 0 for a null text, a text without letters, or when no
    document is labelled. A null ``doc_id`` counts as held out. Repeated rows
    are predicted alike; columns other than ``doc_id``, ``text`` and ``lang``
    are ignored, and ``lang`` is read for training only.
    """
    # Plain arrays: a broadcast object's class would have to be installed on the executors.
    model = docs.sparkSession.sparkContext.broadcast(vars(train(docs, rows, chars)))

    def predict(batch: pa.RecordBatch):
        parser = CrossParser.__new__(CrossParser)
        parser.__dict__.update(model.value)
        found = parser.identify(batch["text"].to_pylist())
        columns = [pa.array(x, t) for x, t in zip(zip(*found), (pa.string(), pa.float64(), pa.float64()))]
        names = SCHEMA.replace(",", "").split()[::2]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], *columns], names=names)

    held = F.coalesce(one_of_three("doc_id", 3) == 1, F.lit(True)).alias("held_out")
    return map_batches(docs.select("doc_id", held, "text"), predict, SCHEMA)
