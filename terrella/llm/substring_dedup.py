"""Removal of passages that repeat across documents, by sliding sentence spans.

Every text is cut into sentences. At each sentence starts a run: the fewest
consecutive sentences, two at least, that reach ``min_words`` words. Runs are
hashed and joined globally; the sentences of every run that occurred before, in
an earlier document or earlier in the same one, are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import map_batches, materialize

MIN_WORDS = 20
#: Words after which a sentence without an end is cut.
LONGEST = 40

RUNS = "h1 bigint, h2 bigint, doc_id bigint, n1 bigint, n2 bigint, start int, sentences int"
#: After an end mark or a line break, and before a capitalised word, as passages are pasted inside sentences too.
_BORDER = re.compile(r"[.!?]+[\"')\]]*\s*|\n\s*|(?<=\s)(?=[^\W\d_a-zß-öø-ÿ][^\W\d_A-ZÀ-ÖØ-Þ])")
_WORD = re.compile(r"\S+")


def sentences(text: str) -> list[tuple[int, int, int]]:
    """(start, end, words) of each sentence; together they cover the text."""
    ends = [m.end() for m in _BORDER.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    found, start = [], 0
    for end in ends:
        if end == start:
            continue
        words = len(text[start:end].split())
        if words > LONGEST:
            at = [m.start() for m in _WORD.finditer(text, start, end)]
            cuts = [start, *at[LONGEST::LONGEST], end]
            found += [(a, b, min(LONGEST, words - LONGEST * i)) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        else:
            found.append((start, end, words))
        start = end
    return found


def runs(text: str | None, min_words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, sentences, content) of each run; content ignores white space at the ends."""
    parts = sentences(text) if text else []
    found, last, words = [], -1, 0
    for first in range(len(parts)):
        while last + 1 < len(parts) and (words < min_words or last < first + 1):
            last += 1
            words += parts[last][2]
        if words < min_words or last < first + 1:
            break
        content = text[parts[first][0] : parts[last][1]].strip()
        found.append((first, last - first + 1, content.encode("utf-8", "surrogatepass")))
        words -= parts[first][2]
    return found


def hashed_runs(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per run, with a 128-bit hash of its content."""

    def hashed(batch: pa.RecordBatch):
        from xxhash import xxh3_128_digest

        ids, digests, places = [], [], []
        for row, (doc_id, text) in enumerate(zip(batch["doc_id"].to_pylist(), batch["text"])):
            for first, count, content in runs(text.as_py(), min_words):
                ids.append(doc_id)
                digests.append(xxh3_128_digest(content))
                places.append((row, first, count))
        pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        placed = np.array(places, np.int32).reshape(-1, 3)
        names = [batch[n].take(pa.array(placed[:, 0])) for n in ("_n1", "_n2")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(ids, pa.int64()), *names, *map(pa.array, placed.T[1:])],
            names=["h1", "h2", "doc_id", "n1", "n2", "start", "sentences"],
        )

    return map_batches(docs.select("doc_id", "_n1", "_n2", "text"), hashed, RUNS)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents that lose sentences: (doc_id, text, n_sentences, n_removed, spans, first_docs).

    ``text`` is what stays, ``spans`` the removed code points as start:end
    pairs, ``first_docs`` the ids of the documents that keep the passages.
    Earlier means a smaller ``doc_id``, then a smaller sentence number. Null
    and empty texts have no runs. Rows with a null ``doc_id`` come last in that
    order. Rows that repeat a ``doc_id`` are told apart by their texts; full
    copies with the same id count as one and are cleaned alike. A table without
    repeats gives an empty result. Other columns are ignored.
    """
    # Rows with one id, of which null may be a frequent one, differ by 128 bits of their text.
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_n1"), F.xxhash64(F.lit("again"), "text").alias("_n2"))
    order = [F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), "n1", "n2", "start"]
    found = hashed_runs(docs, min_words)
    place = F.struct(*order)
    # Counts per hash are gathered before they are shuffled.
    firsts = found.groupBy("h1", "h2").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    firsts = materialize(firsts.filter("_first < _last"), "repeats")
    repeated = found.join(firsts.select("h1", "h2", "_first"), ["h1", "h2"]).filter(place > F.col("_first"))
    owner = F.when(F.col("_first.d") < F.lit(2**63 - 1), F.col("_first.d")).alias("first_doc")
    marks = repeated.select("doc_id", "n1", "n2", "start", "sentences", owner)
    # At most one mark per sentence of the document.
    marked = marks.groupBy("doc_id", "n1", "n2").agg(
        F.collect_list(F.struct("start", "sentences")).alias("marks"), F.collect_set("first_doc").alias("first_docs")
    )
    same = docs["doc_id"].eqNullSafe(marked["doc_id"]) & (docs["_n1"] == marked["n1"]) & (docs["_n2"] == marked["n2"])
    hit = docs.join(marked, same).select(docs["doc_id"], "text", "marks", F.array_sort("first_docs").alias("first_docs"))

    def clean(batches):
        for rows in batches:
            out = []
            for text, marks in zip(rows["text"], rows["marks"]):
                parts = sentences(text)
                gone = np.zeros(len(parts) + 1, np.int64)
                for m in marks:
                    gone[m["start"]] += 1
                    gone[m["start"] + m["sentences"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                spans = []
                for (start, end, _), g in zip(parts, gone):
                    if g and spans and spans[-1][1] == start:
                        spans[-1][1] = end
                    elif g:
                        spans.append([start, end])
                stays = "".join(text[s:e] for (s, e, _), g in zip(parts, gone) if not g)
                out.append((stays, len(parts), int(gone.sum()), ",".join(f"{s}:{e}" for s, e in spans)))
            cleaned = pd.DataFrame(out, columns=["text", "n_sentences", "n_removed", "spans"])
            cleaned.insert(0, "doc_id", rows["doc_id"].astype("Int64"))
            yield cleaned.assign(first_docs=rows["first_docs"])

    return hit.mapInPandas(
        clean, "doc_id bigint, text string, n_sentences long, n_removed long, spans string, first_docs array<bigint>"
    )
