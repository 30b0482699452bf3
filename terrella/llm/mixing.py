"""Mixing sources to target weights along a curriculum that changes over training.

Every source has a schedule: a weight for each moment of training, from 0 to 1,
linear between knots. The integral of the schedule is the source's weight in
the whole mix; its share of all words is its target, which stops at a number of
passes over the source. The documents of a source stand in a drawn order and
are taken pass after pass until the target is reached; the last one is cut. A
document's place in its source's demand, in words, is turned into a moment of
training by inverting the integral of the schedule, and all entries are sorted
by it in ranges.

Running sums go over ranges of the whole order, never over a source as one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrella.functions.numeric import drawn_bits
from terrella.llm.common import materialize, prepare
from terrella.operators.joins import broadcast_if_small
from terrella.operators.positions import CHUNK, number_chunked, range_chunks, running_offsets
from terrella.operators.skew import null_safe_join

#: (moment, weight) knots, dealt to the sources in order, again and again: weights 5, 2 and 1 on the whole, the
#: heaviest falling over training and the lightest rising.
SCHEDULES = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))
#: Passes over a source at most.
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"

_STRETCH = ("start", "weight", "slope", "before")


def integrated(schedule: Sequence[tuple[float, float]]) -> tuple[float, list[tuple[float, float, float, float]]]:
    """Integral of a schedule, and per stretch: start, weight there, slope, integral before it."""
    moments = [m for m, _ in schedule]
    rising = all(a < b for a, b in zip(moments, moments[1:]))
    if len(schedule) < 2 or moments[0] != 0 or moments[-1] != 1 or not rising or min(w for _, w in schedule) < 0:
        raise ValueError("a schedule goes from moment 0 to moment 1 with weights of 0 or more")
    total, stretches = 0.0, []
    for (a, w), (b, v) in zip(schedule, schedule[1:]):
        stretches.append((a, w, (v - w) / (b - a), total))
        total += (w + v) / 2 * (b - a)
    if not total > 0:
        raise ValueError("a schedule needs weight somewhere")
    return total, stretches


def moment(share: Column, stretches: Column, total: Column) -> Column:
    """When the integral of a schedule reaches a share of its whole."""
    wanted = share * total
    last = F.element_at(F.filter(stretches, lambda s: s["before"] <= wanted), -1)
    rest = wanted - last["before"]
    root = F.sqrt(F.greatest(last["weight"] * last["weight"] + 2.0 * last["slope"] * rest, F.lit(0.0)))
    step = F.coalesce(F.try_divide(2.0 * rest, last["weight"] + root), F.lit(0.0))
    return F.least(last["start"] + step, F.lit(1.0))


def source_targets(
    sources: DataFrame, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, repeats: int = REPEATS
) -> DataFrame:
    """Add ``target``, ``weight`` and ``stretches`` to rows (source, source_size).

    Sources stand by code point, null last, and the schedules are dealt in that
    order. Each gets its weight's share of all words, but no more than
    ``repeats`` times its own; what is left goes to the others by weight, until
    none is above. Each round is one small aggregate.
    """
    solved = [integrated(s) for s in schedules]
    stretches = [
        F.array(*[F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(s, _STRETCH)]) for s in found]) for _, found in solved
    ]
    dealt = F.array(*[F.struct(F.lit(t).alias("total"), s.alias("p")) for (t, _), s in zip(solved, stretches)])
    chunked = range_chunks(sources.withColumn("_last", F.col("source").isNull()), ["_last", "source"])
    ranked = number_chunked(chunked, ["_last", "source"], "_rank").drop("_last")
    mine = F.get(dealt, F.pmod(F.col("_rank"), F.lit(len(solved))).cast("int"))
    weighed = ranked.withColumn("weight", mine["total"]).withColumn("stretches", mine["p"]).drop("_rank")
    # Weights add up exactly as decimals, in whatever order.
    weighed = materialize(weighed.withColumn("_exact", F.col("weight").cast("decimal(20,9)")), "sources")
    cap = repeats * F.col("source_size")
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped, free = 0.0, -1, None
    while words:
        above = cap < F.col("weight") * F.lit(level)
        row = weighed.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("capped"),
            F.sum(F.when(~above, F.col("_exact"))).alias("free"),
        ).first()
        if row["capped"] == capped or row["free"] is None:
            break
        capped, free = row["capped"], float(row["free"])
        level = max(level, (words - capped) / free)
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return weighed.withColumn("target", target).drop("_exact")


def plan_mix(
    docs: DataFrame,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    repeats: int = REPEATS,
    seed: int = 13,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of each row of ``docs``.

    (doc_id, source, size, source_size, target, entries, _chunk, _number, _base
    and the columns of ``carry``): ``entries`` lists (pass, words, at), the
    number of the pass, how many of the row's first words it takes, and when in
    training. It is empty for rows that are not taken. ``_chunk`` and ``_number``
    name the row in its source, ``_base`` is the source's words before it.

    The order within a source is drawn from seed, id and text, so that reruns
    agree; full copies are interchangeable. A null or empty text has size 0 and
    is never taken. A null source is a source, the last. Further columns of
    ``docs`` are not read and may have any name, if they are not in ``carry``,
    whose names must differ from those of the result.
    """
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    content = F.md5(text.cast("binary"))
    sized = docs.select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        drawn_bits(15, seed, F.col("doc_id"), content).alias("_draw"), content.alias("_content"),
        F.spark_partition_id().alias("_part"), *carry,
    )
    sized = materialize(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialize(source_targets(materialize(totals, "totals"), schedules, repeats), "targets")
    order = ["_draw", "doc_id", "_content", "_part"]
    chunked = range_chunks(sized, ["source", *order])
    per_chunk = chunked.groupBy("source", CHUNK).agg(F.sum("size").alias("amount"))
    offsets = running_offsets(per_chunk, "amount", ["source"]).drop("_all")
    inside = Window.partitionBy("source", CHUNK).orderBy(*order)
    numbered = chunked.select(
        "*", F.row_number().over(inside).alias("_number"),
        F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_inside"),
    )
    key = lambda name: F.coalesce(F.concat(F.lit("+"), F.col(name)), F.lit(""))
    offsets = offsets.select(key("source").alias("_s"), F.col(CHUNK).alias("_c"), F.col("_before"))
    sources = sources.select(key("source").alias("_t"), "source_size", "target", "weight", "stretches")
    keyed = numbered.withColumn("_key", key("source"))
    met = keyed.join(broadcast_if_small(offsets), (F.col("_key") == F.col("_s")) & (F.col(CHUNK) == F.col("_c")))
    met = met.join(broadcast_if_small(sources), F.col("_key") == F.col("_t"))
    goal = F.floor(F.col("target") + 0.5).cast("long")
    met = met.withColumn("_base", F.col("_inside") + F.col("_before")).withColumn("_goal", goal)
    whole = F.when(F.col("source_size") > 0, F.expr("_goal div nullif(source_size, 0)")).otherwise(F.lit(0))
    met = met.withColumn("_whole", whole.cast("int"))
    rest = F.col("_goal") - F.col("_whole") * F.col("source_size") - F.col("_base")
    last = F.greatest(F.least(rest, F.col("size")), F.lit(0).cast("long"))

    def entry(turn: Column) -> Column:
        words = F.when(turn < F.col("_whole"), F.col("size")).otherwise(last)
        done = turn * F.col("source_size") + F.col("_base")
        share = (done.cast("double") + words / 2.0) / F.col("_goal")
        at = moment(share, F.col("stretches"), F.col("weight"))
        return F.struct(turn.alias("pass"), words.alias("words"), at.alias("at"))

    entries = F.when(
        (F.col("_goal") > 0) & (F.col("size") > 0),
        F.filter(F.transform(F.sequence(F.lit(0), F.col("_whole")), entry), lambda e: e["words"] > 0),
    )
    return met.select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce(entries, F.array().cast("array<struct<pass: int, words: bigint, at: double>>")).alias("entries"),
        CHUNK, "_number", "_base", *carry,
    )


def training_order(plan: DataFrame) -> DataFrame:
    """Entries of a plan with ``position``, the words of the training sequence before them.

    Entries are sorted by their moment in ranges of the whole order; at one
    moment, sources come by name and documents in their source's order. Columns:
    those of the plan but ``entries``, then pass, words, at, position.
    """
    others = [c for c in plan.columns if c != "entries"]
    entries = plan.select(*[F.col(c).alias(f"_row{c}" if c == CHUNK else c) for c in others], F.inline("entries"))
    order = ["at", "source", "_base", "pass"]
    chunked = range_chunks(entries, order)
    offsets = running_offsets(chunked.groupBy(CHUNK).agg(F.sum("words").alias("amount")), "amount").drop("_all")
    offsets = broadcast_if_small(offsets.withColumnRenamed(CHUNK, "_c"))
    inside = Window.partitionBy(CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = chunked.withColumn("_words", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    met = summed.join(offsets, F.col(CHUNK) == F.col("_c"))
    placed = met.withColumn("position", F.col("_words") + F.col("_before"))
    return placed.drop(CHUNK, "_c", "_words", "_before").withColumnRenamed(f"_row{CHUNK}", CHUNK)


def mix(docs: DataFrame, carry: Sequence[str] = (), **options) -> DataFrame:
    """The training sequence: doc_id, source, pass, words, at, position and the columns of ``carry``.

    A row takes the first ``words`` words of its document. See :func:`plan_mix`
    for the options and for nulls, ties and copies.
    """
    ordered = training_order(materialize(plan_mix(docs, carry=carry, **options), "plan"))
    return ordered.select("doc_id", "source", "pass", "words", "at", "position", *carry)


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """Words taken of every row: (doc_id, size, source_size, target, taken, first_position).

    ``first_position`` counts the words of the training sequence before the
    row's first entry; null if it is not taken.
    """
    plan = materialize(plan_mix(docs, **options), "plan")
    row = ["source", CHUNK, "_number"]
    first = training_order(plan).groupBy(*row).agg(F.min("position").alias("first_position"))
    taken = F.aggregate("entries", F.lit(0).cast("long"), lambda total, e: total + e["words"])
    met = null_safe_join(plan.withColumn("taken", taken), first, row, "left")
    return met.select("doc_id", "size", "source_size", "target", "taken", "first_position")
