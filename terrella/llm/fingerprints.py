"""Merkle fingerprints of documents.

A text is a tree: its leaves are sentences (long ones in pieces), which make up
paragraphs (lines); paragraphs make up sections, which end after a paragraph whose digest says so,
so that an edit moves no border beyond its own section. Every inner node is the
digest of its children's digests. Equal roots mean equal texts; where roots
differ, only differing branches are followed, and the differing leaves locate
the edit.

As a string a fingerprint is ``root|section=paragraph:leaf.length,leaf.length/...;section=...``.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrella.operators.positions import quantile_chunks

#: A paragraph ends its section once in so many times.
SECTION = 8
#: Rows of one stretch of the order by id, and the most stretches; a stretch is streamed, not held.
STRETCH_ROWS, STRETCHES = 4096, 65_536

#: A sentence, or a piece of it of about 48 code points that ends with a word.
_LEAF = re.compile(r"[^.!?\n]{0,48}[^\s.!?]*[.!?]*[^\S\n]*")


def _digest(content: bytes) -> bytes:
    return blake2b(content, digest_size=16).digest()


class Tree:
    """Sections [(digest, paragraphs [(digest, leaves [(digest, length)])])] and the root."""

    def __init__(self, text: str | None):
        self.sections = []
        paragraphs = []
        for line in (text or "").split("\n") if text else ():
            leaves = []
            for m in _LEAF.finditer(line):
                leaf = m.group()
                if leaf:
                    leaves.append((_digest(leaf.encode("utf-8", "surrogatepass")), len(leaf)))
            paragraph = _digest(b"p" + b"".join(d for d, _ in leaves))
            paragraphs.append((paragraph, leaves))
            if paragraph[0] % SECTION == 0:
                self._close(paragraphs)
                paragraphs = []
        if paragraphs:
            self._close(paragraphs)
        self.root = _digest(b"r" + b"".join(d for d, _ in self.sections))

    def _close(self, paragraphs) -> None:
        self.sections.append((_digest(b"s" + b"".join(d for d, _ in paragraphs)), paragraphs))

    def __str__(self) -> str:
        return (
            self.root.hex()
            + "|"
            + ";".join(
                s[:8].hex()
                + "="
                + "/".join(p[:6].hex() + ":" + ",".join(f"{d[:4].hex()}.{n}" for d, n in ls) for p, ls in ps)
                for s, ps in self.sections
            )
        )


def _unshared(left: list, right: list) -> tuple[list, list, list]:
    """Children only in the left, only in the right, and shared, as multisets."""
    count, shared = Counter(node[0] for node in right), []
    only_left = []
    for node in left:
        if count[node[0]] > 0:
            count[node[0]] -= 1
            shared.append(node)
        else:
            only_left.append(node)
    only_right = []
    for node in reversed(right):
        if count[node[0]] > 0:
            count[node[0]] -= 1
            only_right.append(node)
    return only_left, only_right[::-1], shared


def _length(node) -> int:
    below = node[1]
    return below if isinstance(below, int) else sum(map(_length, below))


def likeness(left: Tree, right: Tree) -> float:
    """Share of code points in equal branches, 0 to 1; 1 exactly if the roots are equal."""
    if left.root == right.root:
        return 1.0
    a, b, same = left.sections, right.sections, 0
    total = sum(map(_length, a)) + sum(map(_length, b))
    for _ in range(3):  # sections, then paragraphs, then leaves of the branches that differ
        a, b, shared = _unshared(a, b)
        same += sum(map(_length, shared))
        if a and not isinstance(a[0][1], int):
            a = [child for node in a for child in node[1]]
        if b and not isinstance(b[0][1], int):
            b = [child for node in b for child in node[1]]
        if not a or not b:
            break
    return min(2.0 * same / total, 1 - 1e-9) if total else 0.0


def changed_spans(left: str, right: str) -> list[tuple[int, int]]:
    """Code points of ``right`` in leaves that ``left`` lacks: where an edit took place."""
    known = Counter(d for _, ps in Tree(left).sections for _, ls in ps for d, _ in ls)
    spans, at = [], 0
    for _, paragraphs in Tree(right).sections:
        for _, leaves in paragraphs:
            for digest, length in leaves:
                if known[digest] > 0:
                    known[digest] -= 1
                elif spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + length)
                else:
                    spans.append((at, at + length))
                at += length
            at += 1
    return spans


def with_next(docs: DataFrame) -> DataFrame:
    """Rows sorted by id in stretches, each followed by the row that comes after it.

    Adds ``_stretch``, ``_sub`` and ``_guest``: the first row of every stretch
    also visits the stretch before as a guest (the first row of all visits the
    last stretch). Null ids come first and are cut by a hash of the text, in
    whose order equal ids stand.
    """
    spark = docs.sparkSession
    count = docs.count()
    docs = docs.withColumn("_h", F.xxhash64("text"))
    stretches = min(STRETCHES, max(8, -(-count // STRETCH_ROWS)))
    placed = quantile_chunks(docs, "doc_id", stretches).withColumnRenamed("_chunk", "_stretch")
    sub = F.when(F.col("doc_id").isNull(), F.shiftright("_h", 54)).otherwise(0)
    placed = placed.withColumn("_sub", sub.cast("int"))
    firsts = placed.groupBy("_stretch", "_sub").agg(F.min(F.struct("doc_id", "_h")).alias("f"))
    rows = firsts.orderBy("_stretch", "_sub").collect()  # one short row per stretch
    guests = [
        (rows[i - 1]["_stretch"], rows[i - 1]["_sub"], r["f"]["doc_id"], r["f"]["_h"]) for i, r in enumerate(rows)
    ]
    visits = spark.createDataFrame(guests, "_to int, _to_sub int, _id bigint, _hash bigint")
    met = placed["doc_id"].eqNullSafe(visits["_id"]) & placed["_h"].eqNullSafe(visits["_hash"])
    guest = placed.join(F.broadcast(visits), met).select(
        "doc_id", "text", "_h", F.col("_to").alias("_stretch"), F.col("_to_sub").alias("_sub"), F.lit(1).alias("_guest")
    )
    own = placed.select("doc_id", "text", "_h", "_stretch", "_sub", F.lit(0).alias("_guest"))
    return (
        own.union(guest)
        .repartition("_stretch", "_sub")
        .sortWithinPartitions("_stretch", "_sub", "_guest", "doc_id", "_h")
    )


FINGERPRINTS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many of the next document in ascending ``doc_id`` (the first after
    the last; itself if it is alone). A null text counts as empty. Null ids come
    first; rows with equal ids are ordered by a hash of their text, and full
    copies of a row follow each other in any order. Only ``doc_id`` and ``text``
    are read.
    """

    def row(doc_id, text, tree, next_text, next_tree):
        half = len(text) // 2
        edited = text[: len(text) - half] + next_text[:half]
        edited_tree = Tree(edited)
        return (
            doc_id,
            len(text),
            sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            str(tree),
            str(edited_tree),
            likeness(tree, edited_tree),
            likeness(tree, next_tree),
        )

    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = FINGERPRINTS.replace(",", "").split()[::2]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def compute(batches):
        place = held = None
        for batch in batches:
            out = []
            columns = [batch[c] for c in ("_stretch", "_sub", "_guest", "doc_id", "text")]
            for stretch, sub, guest, doc_id, text in zip(*columns):
                at, guest, text = (stretch.as_py(), sub.as_py()), guest.as_py(), text.as_py() or ""
                if guest and held is None:
                    continue  # a copy of a guest that has been met
                tree = Tree(text)
                if held is not None:
                    assert place == at, "a stretch ends with its guest"
                    out.append(row(*held, text, tree))
                place, held = at, None if guest else (doc_id.as_py(), text, tree)
            if out:
                yield pack(out)

    return with_next(docs.select("doc_id", "text")).mapInArrow(compute, FINGERPRINTS)
