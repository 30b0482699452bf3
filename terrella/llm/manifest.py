"""A Merkle tree over all rows of a table, kept as strings that hold a level each.

Leaves of a group (a language) are numbered in the order of their ids and cut
into aligned blocks of 256. A block is one row. It keeps every level as one
string of hex digests: a parent hashes 128 characters of the level below, the
sibling of a node is the 64 characters next to it. The roots of the blocks are
the nodes of the next round, until a group has one root; the roots of the
groups, in order, make a tree of the same kind. Paths then come down the same
way: each block hands its nodes their siblings and what its own root got.

No task holds more than a block of a group. Rows are numbered in ranges of the
whole order, so that a group with most rows is no different from the others.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import materialize, prepare
from terrella.operators.positions import number_chunked, range_chunks

#: Levels that a block resolves, and hex digits of a digest.
BLOCK_LEVELS, DIGITS = 8, 64
BLOCK = 1 << BLOCK_LEVELS
#: Columns a leaf is made of, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as text that cannot run into its neighbours: ``-``, or its UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row; ``changed`` gives values that stand in for columns."""
    return digest(*[field(changed.get(name, F.col(name))) for name in FIELDS])


def _levels(items: str, steps: Column) -> Column:
    """The level of the items' digests and ``steps`` levels above it, a string each."""
    start = F.array_join(F.transform(items, lambda item: item["digest"]), "")

    def above(levels: Column, _: Column) -> Column:
        below = F.element_at(levels, -1)
        last = F.floor((F.length(below) - 1) / (2 * DIGITS)).cast("int")
        parents = F.transform(
            F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(below, i * (2 * DIGITS) + 1, 2 * DIGITS), 256)
        )
        return F.array_append(levels, F.array_join(parents, ""))

    rounds = F.slice(F.sequence(F.lit(1), F.lit(BLOCK_LEVELS)), F.lit(1), steps)
    return F.aggregate(rounds, F.array(start), above)


def _segment(level: Column, place: Column) -> Column:
    """Digest at a place of a level; empty beyond either end."""
    return F.when(place < 0, F.lit("")).otherwise(F.substring(level, place * DIGITS + 1, DIGITS))


def _siblings(levels: Column, place: Column, steps: Column) -> Column:
    """What stands left and right of a node and of each node above it inside its block."""

    def flanks(step: Column) -> Column:
        at = F.call_function("shiftright", place, step)
        level = F.element_at(levels, step + 1)
        even = at % 2 == 0
        return F.struct(
            F.when(even, F.lit("")).otherwise(_segment(level, at - 1)).alias("left"),
            F.when(even, _segment(level, at + 1)).otherwise(F.lit("")).alias("right"),
        )

    every = F.slice(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1)), F.lit(1), steps)
    return F.transform(every, flanks)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Rows of 256 nodes (_group, position, size, digest and others) with all their levels."""
    others = [c for c in nodes.columns if c not in ("_group", "position", "size")]
    grouped = nodes.groupBy("_group", F.shiftright("position", BLOCK_LEVELS).alias("block")).agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("position", *others))).alias("items")
    )
    halvings = F.when(F.col("size") > 1, F.least(F.length(F.bin(F.col("size") - 1)), F.lit(BLOCK_LEVELS)))
    stepped = grouped.withColumn("steps", F.coalesce(halvings, F.lit(0)))
    return materialize(stepped.withColumn("levels", _levels("items", F.col("steps"))), "blocks")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of each round from the leaves up, and the one root of each group: (_group, digest)."""
    largest = nodes.agg(F.max("size")).first()[0] or 1
    rounds = []
    while True:
        rounds.append(_blocks(nodes))
        nodes = rounds[-1].select(
            "_group",
            F.col("block").alias("position"),
            F.shiftright(F.col("size") + (BLOCK - 1), BLOCK_LEVELS).alias("size"),
            F.element_at("levels", -1).alias("digest"),
        )
        largest = (largest + BLOCK - 1) >> BLOCK_LEVELS
        if largest <= 1:
            return rounds, nodes.select("_group", "digest")


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Nodes of the lowest round with their whole path; ``tops`` gives each group its path and other columns."""
    above = tops.withColumn("_block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        above = above.withColumnRenamed("_group", "_theirs")
        met = blocks.join(above, (F.col("_group") == F.col("_theirs")) & (F.col("block") == F.col("_block")))
        handed = [c for c in above.columns if c not in ("_theirs", "_block", "path")]
        nodes = met.select("_group", "levels", "steps", "path", *handed, F.explode("items").alias("item"))
        place = F.pmod(F.col("item.position"), F.lit(BLOCK)).cast("int")
        own = _siblings(F.col("levels"), place, F.col("steps"))
        above = nodes.select(
            "_group", "item", *handed, F.concat(own, F.col("path")).alias("path"), F.col("item.position").alias("_block")
        )
        if blocks is not rounds[0]:
            above = above.drop("item")
    return above


def fold(start: Column, path: Column) -> Column:
    """Root that a leaf digest and its path lead to."""
    return F.aggregate(path, start, lambda low, step: digest(step["left"], low, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(docs: DataFrame, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """A row per row of ``docs``: doc_id, lang, position, leaf, path, subroot, root and the columns of ``carry``.

    ``position`` counts from 0 within the language, ids ascending. ``path`` lists
    (left, right) from the leaf through the language's root to the root of all;
    at most one of the two is not empty, and both are where a node has no
    sibling. ``carry`` holds columns worked out on ``docs`` in the same scan.

    A null value, a null language and a null id are values of their own and sort
    first. Rows of one id follow one another by the digest of their content, so
    that full copies take neighbouring places, each with its own path. An empty
    table gives no rows. Further columns of ``docs`` are not read and may have
    any name; names of ``carry`` must differ from those of the result.
    """
    carry = dict(carry or {})
    spark = prepare(docs.sparkSession)
    group = F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit(""))
    leaves = docs.select(
        group.alias("_group"), F.col("doc_id"), leaf_digest().alias("digest"), F.spark_partition_id().alias("_part"),
        *[c.alias(n) for n, c in carry.items()],
    )
    order = ["doc_id", "digest", "_part"]
    chunked = range_chunks(materialize(leaves, "leaves"), ["_group", *order])
    placed = number_chunked(chunked, order, "position", ["_group"], "size").drop("_part")
    rounds, subroots = _climb(placed)
    named = materialize(subroots.select(F.lit("all").alias("_group"), F.col("_group").alias("name"), "digest"), "subroots")
    groups = number_chunked(range_chunks(named, ["name"]), ["name"], "position", size="size")
    higher, roots = _climb(groups)
    root = roots.select("digest").scalar() if named.head(1) else F.lit(None).cast("string")
    empty = F.lit([]).cast("array<struct<left: string, right: string>>")
    start = spark.range(1).select(F.lit("all").alias("_group"), empty.alias("path"), root.alias("root"))
    tops = _descend(higher, start).select(
        F.col("item.name").alias("_group"), "path", "root", F.col("item.digest").alias("subroot")
    )
    return _descend(rounds, materialize(tops, "tops")).select(
        F.col("item.doc_id").alias("doc_id"),
        F.when(F.col("_group") != "", F.substring("_group", 2, 1 << 30)).alias("lang"),
        F.col("item.position").alias("position"),
        F.col("item.digest").alias("leaf"),
        "path",
        "subroot",
        "root",
        *[F.col(f"item.{n}").alias(n) for n in carry],
    )


def manifest_digest(docs: DataFrame) -> DataFrame:
    """Each row's place in the tree and a check against tampering.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified). Rows whose
    id's crc32 is a multiple of 7 are folded with one character more than they
    tell; a null number of characters or a null id is left as it is.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when((crc % 7 == 0) & F.col("n_chars").isNotNull(), leaf_digest(n_chars=more))
    rows = manifest(docs, {"tampered": tampered})
    folded = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
