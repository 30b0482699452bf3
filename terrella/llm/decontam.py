"""Benchmark decontamination by template canonicalisation.

Texts become templates: names, numbers and units turn into typed placeholders,
case and punctuation go. Windows of consecutive template words of benchmark
items and documents meet in a hash join. For the documents that match, the
values behind the placeholders are read again: along one alignment of item and
document, equal values of the item must stand against equal values of the
document. Each item value stands for the document value that most windows give
it; windows that hold another one do not count. So a question with new numbers
or names is caught, also if one of them breaks the pattern, while matches that
mix values throughout are not. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.llm.common import materialize

#: Template words of a window, those of them that must be no placeholder, and matched windows that count.
WINDOW, LITERALS, LEAST = 8, 5, 3
#: Least template words of an item, and of one that is found with other values though it has few literal words.
LEAST_WORDS, LOOSE_WORDS = 3, 6
#: Literal words without which an item is found with equal values only.
LOOSE_LITERALS = 2
#: Rows that may be broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of documents' matched windows that may be broadcast, and the bytes of one row and one window.
BROADCAST_BYTES, ROW_BYTES, WINDOW_BYTES = 16 << 20, 64, 32

NAME, NUMBER, UNIT = "", "", ""
#: Units of measure after a number: fixed values.
_UNITS = (
    "mm|cm|dm|km|m|mg|kg|g|t|ml|cl|l|ms|s|sec|seconds|min|minutes|h|hours|days|weeks|months|years|"
    "hz|khz|mhz|ghz|w|kw|mw|kwh|v|a|j|kj|cal|kcal|pa|kpa|bar|c|f|k|percent|%|usd|eur|gbp|dollars|euros|"
    "meters|metres|kilometers|kilometres|miles|feet|inches|grams|kilograms|pounds|ounces|liters|litres"
)
_NAME = r"(?<=[\p{Ll},]\x20)\p{Lu}[\p{L}'-]*+"
_NUMBER = r"[0-9]++(?:[.,:/][0-9]++)*+"
_UNIT = rf"(?<=[0-9]\x20?)(?i:{_UNITS})(?![\p{{L}}\p{{N}}])"
_SLOT = f"{_NAME}|{_NUMBER}|{_UNIT}"
_BREAK = rf"[^\p{{L}}\p{{N}}{NAME}{NUMBER}{UNIT}]+"


def template(text: Column) -> Column:
    """Template words of a text."""
    # Characters used as placeholders below lose their meaning first.
    text = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT, "   ")
    text = F.regexp_replace(text, _NAME, f" {NAME} ")
    digits = F.regexp_replace(F.regexp_replace(text, _UNIT, f" {UNIT} "), _NUMBER, f" {NUMBER} ")
    text = F.when(text.rlike("[0-9]"), digits).otherwise(text)
    return F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")


def slot_values(text: Column) -> Column:
    """Values of the placeholders in order."""
    text = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT, "   ")
    return F.transform(F.regexp_extract_all(text, F.lit(_SLOT), F.lit(0)), F.lower)


def _bound(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, not again for each element of an inner lambda."""
    return F.get(F.transform(F.array(value), fn), 0)


def window_hashes(words: Column, widths: list[int]) -> Column:
    """Hashes of all windows of template words, as one (width, hashes) per width."""

    def all_windows(hashed: Column, width: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashed) - (width - 1))
        each = F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, F.lit(width))))
        found = F.when(F.size(hashed) >= width, each).otherwise(F.array().cast("array<bigint>"))
        return F.struct(F.lit(width).alias("width"), found.alias("hashes"))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _bound(hashed, lambda h: F.array(*[all_windows(h, n) for n in widths]))


def _is_slot(word: Column) -> Column:
    return word.isin(NAME, NUMBER, UNIT)


def windows(rows: DataFrame, widths: list[int], *keys: str) -> DataFrame:
    """(keys, width, pos, hash) of every window of a ``text`` column, read once for all widths."""
    per_width = rows.select(*keys, F.inline(window_hashes(template(F.col("text")), widths)))
    return per_width.select(*keys, "width", F.posexplode("hashes").alias("pos", "hash"))


def with_slots(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, width, pos, hash, literals, slots) of the windows in ``at``, an array of (width, pos, hash), of ``text``."""

    def read(words: Column, values: Column, slots: Column) -> Column:
        def one(w: Column) -> Column:
            first = F.size(F.filter(slots, lambda at: at < w["pos"]))
            count = F.size(F.filter(slots, lambda at: (at >= w["pos"]) & (at < w["pos"] + w["width"])))
            return F.struct(
                w["width"].alias("width"),
                w["pos"].alias("pos"),
                w["hash"].alias("hash"),
                (w["width"] - count).alias("literals"),
                F.slice(values, first + 1, count).alias("slots"),
            )

        return F.transform("at", one)

    def slot_places(words: Column) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(_is_slot(w), i)), lambda i: i.isNotNull())

    text = F.col("text")
    found = _bound(
        template(text), lambda t: _bound(slot_values(text), lambda v: _bound(slot_places(t), lambda at: read(t, v, at)))
    )
    return rows.select(*keys, F.inline(found))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, least: int = LEAST) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, exact) of documents that hold benchmark items.

    A document holds an item if at least ``least`` of the item's windows (all,
    if it has fewer) match along alignments, with slots that agree with what
    most windows of the alignment say. ``exact`` tells that all slot values are
    equal. Items shorter than ``width`` template words are matched as one window
    of their own length; those of fewer than ``LEAST_WORDS`` say too little and
    are never found. An item none of whose windows has ``LITERALS`` literal words
    is found where all its windows match along one alignment: with consistent
    slots from ``LOOSE_WORDS`` template words and ``LOOSE_LITERALS`` literal ones
    on, with equal slot values otherwise. Null texts are empty and match nothing.
    A null or repeated ``doc_id`` or ``item_id`` is told apart by a hash of the
    text; full copies of a row count once, and results are given once per pair of
    ids. Empty tables give an empty result; other columns are ignored.
    """
    return _found(docs, benchmark, width, least).groupBy("doc_id", "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"), F.max("exact").alias("exact")
    )


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, _i, width, pos, hash, slots, whole, loose, item_windows) of the windows that items are found by.

    ``whole`` tells that all of them must match, ``loose`` that their values may differ.
    """
    items = benchmark.select("item_id", "text", F.xxhash64("text").alias("_i")).distinct()
    items = items.withColumn("_words", template(F.col("text"))).withColumn("_n", F.size("_words"))
    literal = F.size(F.filter("_words", lambda w: ~_is_slot(w)))
    loose = (F.col("_n") >= LOOSE_WORDS) & (literal >= LOOSE_LITERALS)
    asked = None
    for n in range(LEAST_WORDS, width + 1):
        of_width = items.filter(F.col("_n") >= n if n == width else F.col("_n") == n)
        hashes = window_hashes(F.col("_words"), [n])[0]["hashes"]
        at = F.transform(hashes, lambda h, i: F.struct(F.lit(n).alias("width"), i.alias("pos"), h.alias("hash")))  # noqa: B023
        of_width = of_width.select("item_id", "_i", "text", loose.alias("loose"), at.alias("at"))
        asked = of_width if asked is None else asked.unionByName(of_width)
    item = Window.partitionBy("item_id", "_i")
    read = with_slots(asked, "item_id", "_i", "loose").withColumn("whole", F.max("literals").over(item) < LITERALS)
    read = read.filter(F.col("whole") | (F.col("literals") >= LITERALS)).drop("literals")
    return read.withColumn("item_windows", F.count("*").over(item))


def _found(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, least: int = LEAST) -> DataFrame:
    """As :func:`contaminated`, by document id and text hash ``_h``."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_h"))
    wanted = materialize(item_windows(benchmark, width), "benchmark-windows")
    widths = sorted(r["width"] for r in wanted.select("width").distinct().collect())  # at most ``width`` values
    hashes = wanted.select("hash").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        hashes = F.broadcast(hashes)
    hits = windows(docs, widths or [width], "doc_id", "_h").join(hashes, "hash", "left_semi")
    gathered = F.collect_set(F.struct("width", "pos", "hash")).alias("at")
    hits = materialize(hits.groupBy("doc_id", "_h").agg(gathered), "window-hits")
    size = hits.agg(F.sum(F.size("at") * F.lit(WINDOW_BYTES) + F.lit(ROW_BYTES))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    same = docs["doc_id"].eqNullSafe(hits["doc_id"]) & docs["_h"].eqNullSafe(hits["_h"])
    matched = docs.join(hits, same).select(docs["doc_id"], docs["_h"], "text", "at").dropDuplicates(["doc_id", "_h"])
    spread = with_slots(matched, "doc_id", "_h").select(
        "doc_id", "_h", "width", "hash", F.col("pos").alias("_at"), F.col("slots").alias("_theirs")
    )
    alignment = ("doc_id", "_h", "item_id", "_i", "_shift")
    met = spread.join(wanted, ["width", "hash"]).withColumn("_shift", F.col("_at") - F.col("pos"))
    # One exchange serves all windows and groups below; an alignment has at most as many windows as its item.
    met = met.repartition(*alignment)
    slots = F.explode_outer(F.arrays_zip(F.col("slots").alias("a"), F.col("_theirs").alias("b"))).alias("_slot")
    slots = met.select(*alignment, "pos", "whole", "loose", "item_windows", slots)
    slots = slots.select("*", F.col("_slot.a").alias("_a"), F.col("_slot.b").alias("_b"))
    votes = slots.withColumn("_votes", F.count("*").over(Window.partitionBy(*alignment, "_a", "_b")))
    most = F.max(F.struct("_votes", "_b")).over(Window.partitionBy(*alignment, "_a"))
    judged = votes.withColumn("_agrees", F.col("_a").isNull() | (F.col("_b") == most["_b"]))
    equal = F.col("_a").isNull() | (F.col("_a") == F.col("_b"))
    per_window = judged.groupBy(*alignment, "pos", "whole", "loose", "item_windows").agg(
        F.min("_agrees").alias("_agrees"), F.min(equal).alias("_equal")
    )
    counts = F.when(F.col("whole") & ~F.col("loose"), F.col("_equal")).otherwise(F.col("_agrees"))
    aligned = per_window.groupBy(*alignment, "whole", "item_windows").agg(
        F.collect_set(F.when(counts, F.col("pos"))).alias("_at"), F.min("_equal").alias("exact")
    )
    aligned = aligned.filter(~F.col("whole") | (F.size("_at") == F.col("item_windows")))
    # Alignments with at least some windows in common are pieces of one occurrence.
    covered = aligned.select("doc_id", "_h", "item_id", "_i", "item_windows", "exact", F.explode("_at").alias("pos"))
    counted = covered.groupBy("doc_id", "_h", "item_id", "_i").agg(
        F.countDistinct("pos").alias("n_windows"), F.max("item_windows").alias("item_windows"), F.min("exact").alias("exact")
    )
    return counted.filter(F.col("n_windows") >= F.least(F.lit(least), F.col("item_windows"))).drop("_i")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item, with all their columns; rows are told apart by id and text."""
    hits = _found(docs, benchmark).select(F.col("doc_id").alias("_hit_id"), F.col("_h").alias("_hit_text"))
    hits = materialize(hits.distinct(), "contaminated")
    if hits.count() <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    same = docs["doc_id"].eqNullSafe(hits["_hit_id"]) & F.xxhash64(docs["text"]).eqNullSafe(hits["_hit_text"])
    return docs.join(hits, same, "left_anti")
