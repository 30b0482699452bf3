"""Spans of regular-expression matches in code points, with SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,value:string>"


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def find_spans(text: Column, pattern: str | Column, kind: str) -> Column:
    """Leftmost non-overlapping matches as an array of (kind, start, end, value).

    Splitting at the matches gives the gaps between them; adding up the lengths
    of gaps and matches gives the offsets. The pattern must not match nothing.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pieces = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("value"), F.split(text, pattern, -1).alias("gap")
    )
    start = F.struct(F.lit(0).alias("at"), no_spans().alias("found"))

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["value"])
        span = F.struct(
            F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), piece["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.array_append(acc["found"], span).alias("found"))

    # The last piece is the gap after the last match.
    inner = F.filter(pieces, lambda p: p["value"].isNotNull())
    return F.aggregate(inner, start, step, lambda acc: acc["found"])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def blanked(text: Column, spans: Column) -> Column:
    """The text with a space for each code point of the spans, so that offsets stay."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        space = F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(acc["at"], s["start"])))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], F.array(gap, space)).alias("parts")
        )

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), F.length(text) - acc["at"]))
        return F.concat(F.array_join(acc["parts"], ""), rest)

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, zero, step, finish))


def replaced(text: Column, spans: Column, replacement) -> Column:
    """The text with each span replaced by ``replacement(span)``; overlapping spans count as one, the first."""
    ordered = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), replacement(s).alias("by"))
        )
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["parts"], F.array(gap, s["by"]))).otherwise(acc["parts"]).alias("parts"),
        )

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), F.length(text) - acc["at"]))
        return F.concat(F.array_join(acc["parts"], ""), rest)

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, zero, step, finish))
