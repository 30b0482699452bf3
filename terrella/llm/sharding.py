"""Shuffled shards by a two-pass external shuffle.

First pass: every record is scattered by seeded hashes, to a shard and to one
of the shard's buckets, whose number is chosen so that a bucket fits into a
task's memory. Second pass: each bucket is brought together, put into a
canonical order and shuffled by Fisher and Yates' method: one number after the
other is struck from those left, at a place drawn from a hash of seed, shard,
bucket and step. Shards are the buckets in order, so a slot is the rows of the
buckets before plus the place in the bucket. Every draw follows from seed and
rows alone, so a lost task repeats itself under any partitioning.

The law is ``key``: the id and the number of shards decide. The shard is the
one with the highest hash of id and shard (rendezvous hashing), so that a new
shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes that a bucket holds on average, and rows; striking out costs the square of the rows.
BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 8_192
#: Bytes that a task of the second pass reads (it holds one bucket at a time), and the most such tasks.
TASK_BYTES, MOST_TASKS = 64 << 20, 20_000
#: Records of one written file.
FILE_ROWS = 100_000
#: Bytes of a number in the list of those not yet struck out.
_WIDTH = 4
#: Bytes that a record counts besides its text.
OVERHEAD = 16


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def rendezvous(key: str, shards: int, seed: int) -> Column:
    """Shard with the highest seeded hash; ties go to the higher shard."""
    best = F.greatest(*[F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("h"), F.lit(s).alias("s")) for s in range(shards)])
    return best["s"]


def fisher_yates(count: Column, *draw: Column) -> Column:
    """Permutation of 1 to ``count`` as an array, by Fisher and Yates' method.

    The numbers left are a binary string, from which step k strikes the number
    at place hash(draw, k) modulo the numbers left. ``count`` must be positive.
    """
    numbers = F.transform(F.sequence(F.lit(1), count), lambda i: F.lpad(F.hex(i), 2 * _WIDTH, "0"))
    start = F.struct(F.unhex(F.array_join(numbers, "")).alias("left"), F.lit(b"").alias("drawn"))

    def strike(state: Column, k: Column) -> Column:
        at = F.pmod(F.xxhash64(*draw, k), count - k + 1).cast("int") * _WIDTH
        left = state["left"]
        return F.struct(
            F.concat(F.substring(left, F.lit(1), at), F.substring(left, at + 1 + _WIDTH, _WIDTH * count)).alias("left"),
            F.concat(state["drawn"], F.substring(left, at + 1, F.lit(_WIDTH))).alias("drawn"),
        )

    drawn = F.aggregate(F.sequence(F.lit(1), count), start, strike, lambda state: F.hex(state["drawn"]))
    digits = F.regexp_extract_all(drawn, F.lit(f".{{{2 * _WIDTH}}}"), F.lit(0))
    return F.transform(digits, lambda d: F.conv(d, 16, 10).cast("int"))


def shard_records(docs: DataFrame, shards: int = 40, seed: int = 1) -> DataFrame:
    """All rows with ``size``, ``shard``, ``slot`` and ``grown_shard``.

    ``slot`` counts from 0 within the shard without gaps; ``grown_shard`` is the
    shard if there were one more. A null text counts no bytes. Rows without an
    id, or with one id, share a shard, as the id decides; their texts spread
    them over its buckets. Full copies of a row share a bucket. ``docs`` needs
    ``doc_id`` and ``text`` and keeps all its columns; columns named like the new
    ones or starting with ``_shard`` raise an error.
    """
    columns = docs.columns
    new = ("size", "shard", "slot", "grown_shard")
    clashing = [c for c in columns if c.lower() in new or c.lower().startswith("_shard")]
    if clashing:
        raise ValueError(f"columns named like results: {clashing}")
    sized = docs.withColumn("size", size_of(F.col("text")))
    sized = sized.withColumn("_shard_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    shard = rendezvous("_shard_key", shards, seed)
    more = F.struct(F.xxhash64(F.lit(seed), F.lit(shards), "_shard_key").alias("h"), F.lit(shards).alias("s"))
    here = F.struct(F.xxhash64(F.lit(seed), "shard", "_shard_key").alias("h"), F.col("shard").alias("s"))
    placed = sized.withColumn("shard", shard).withColumn("grown_shard", F.greatest(here, more)["s"])
    # Buckets by the largest shard, so that one with a frequent id is cut finely as well.
    totals = placed.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    most = totals.agg(F.max("b"), F.max("n"), F.sum("b")).first()
    buckets = max(1, -(-(most[0] or 0) // BUCKET_BYTES), -(-(most[1] or 0) // BUCKET_ROWS))
    scatter = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(buckets)).cast("int")
    placed = placed.withColumn("_shard_bucket", scatter)
    counts = placed.groupBy("shard", "_shard_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_shard_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_shard_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shard_before")
    )
    kept = [c for c in placed.columns if c not in ("shard", "_shard_bucket", "_shard_key")]
    order = F.struct(F.xxhash64("doc_id", "text").alias("_shard_order"), *kept)
    tasks = min(MOST_TASKS, max(1, min(shards * buckets, -(-(most[2] or 0) // TASK_BYTES))))
    together = placed.repartition(tasks, "shard", "_shard_bucket")
    grouped = together.groupBy("shard", "_shard_bucket").agg(F.array_sort(F.collect_list(order)).alias("_shard_rows"))
    places = fisher_yates(F.size("_shard_rows"), F.lit(seed + 2), F.col("shard"), F.col("_shard_bucket"))
    drawn = grouped.withColumn("_shard_places", places).join(offsets, ["shard", "_shard_bucket"])
    mixed = drawn.select("shard", "_shard_before", "_shard_rows", F.posexplode("_shard_places"))
    record = F.element_at("_shard_rows", F.col("col"))
    return mixed.select(
        *[record[c].alias(c) for c in columns],
        record["size"].alias("size"),
        "shard",
        (F.col("_shard_before") + F.col("pos")).cast("long").alias("slot"),
        record["grown_shard"].alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 1, file_rows: int = FILE_ROWS) -> None:
    """Write the shuffled records: a folder per shard, in it one per ``file_rows`` slots with a file in slot order."""
    part = F.expr(f"slot div {file_rows}").alias("_shard_part")
    placed = shard_records(docs, shards, seed).select("*", part)
    ordered = placed.repartition("shard", "_shard_part").sortWithinPartitions("shard", "_shard_part", "slot")
    ordered.write.partitionBy("shard", "_shard_part").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """Records of a written shard, by slot."""
    return spark.read.parquet(path).filter(F.col("shard") == shard).drop("_shard_part").orderBy("slot")


def shards_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Place of every document: (doc_id, size, text_crc32, law, shard, slot, grown_shard)."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return shard_records(docs.select("doc_id", "text"), shards).select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
