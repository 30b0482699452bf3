"""Secrets in texts: patterns, and tokens that look random to two Markov models.

Two first-order Markov models of printable characters are trained, one on the
values that the patterns label as secrets, one on ordinary tokens. A token, or
what the patterns' spans leave of it, is a secret if the log-likelihood ratio
summed over its characters exceeds a threshold, so that a short token needs
stranger characters than a long one. Only DataFrame functions are used; the
driver sees nothing but two counts and the 95 x 95 table of ratios.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.spans import SPAN, blanked, count_kind, find_spans, joined, no_spans, replaced

KINDS = ("assign", "access", "hex")
RANDOM = "random"
#: Expected size of the training samples (distinct texts with labelled secrets, distinct texts for ordinary
#: tokens) and code points read of each ordinary text and of each sampled token.
SECRET_DOCS, ORDINARY_DOCS, SAMPLE_CHARS = 5000, 2000, 4000
#: Least summed log-likelihood ratio (natural logarithm) of a token: one secret among some 160,000 tokens.
THRESHOLD = 12.0
#: Fewest characters of a token that is scored.
SHORTEST = 8

_NAME = r"(?:[pP][aA][sS][sS](?:[wW][oO][rR][dD]|[wW][dD])|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_ASSIGN = _NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
# A run that is too short has no longer run inside, so that the length can stand in the pattern.
_ACCESS = r"AKIA[A-Z0-9]{12,}+"
_HEX = r"[0-9a-f]{32,}+"
_TOKEN = r"[A-Za-z0-9+/_=-]{%d,}+"
# Words, names, dates, numbers, paths and rulers outside the patterns' spans.
_ORDINARY = r"[A-Za-z0-9+/_=-]{4,}+"
#: A text that the patterns label, up to matches that a shorter one hides.
_LABELLED = f"{_ASSIGN[:-3]}{{8,}}+)|{_ACCESS}|{_HEX}"
#: Weight of single characters in a row of transitions.
BACKOFF = 5.0
#: Characters 32 to 126.
SYMBOLS = 95


def _where(text: Column, pattern: str, kind: str) -> Column:
    return F.when(text.rlike(pattern), find_spans(text, pattern, kind)).otherwise(no_spans())


def _by_start(spans: Column) -> Column:
    """Spans by start, then kind as listed."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, (*KINDS, RANDOM))), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and then kind."""
    assign = F.filter(
        _where(text, _ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["value"], _ASSIGN, 1)) >= 8
    )
    found = F.concat(assign, _where(text, _ACCESS, "access"), _where(text, _HEX, "hex"))
    return F.when(F.size(found) > 1, _by_start(found)).otherwise(found)


def _codes(token: Column) -> Column:
    """Numbers 0 to 94 of a token's characters."""
    return F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.ascii(c) - 32)


def _transitions(codes: Column) -> Column:
    """Number of each pair of neighbouring characters."""
    pairs = F.zip_with(codes, F.slice(codes, 2, F.greatest(F.lit(1), F.size(codes))), lambda a, b: a * SYMBOLS + b)
    return F.filter(pairs, lambda p: p.isNotNull())


def _sample(docs: DataFrame, wanted: int, of: int, pattern: str = "") -> DataFrame:
    """About ``wanted`` of the ``of`` rows that hold ``pattern``, drawn by the hash of their texts; equal texts count once.

    The threshold is known before the rows are read, so that no task gathers candidates.
    """
    draw = F.xxhash64("text", F.lit("sample"))
    least = min(2**63 - 1, int(wanted / max(of, 1) * 2**64) - 2**63)
    drawn = docs.filter(draw <= least).filter(F.col("text").rlike(pattern))
    return drawn.withColumn("draw", draw).dropDuplicates(["draw"])


def train(docs: DataFrame, secret_docs: int = SECRET_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> list[float]:
    """Log-likelihood ratio (random against ordinary) of each transition.

    Labelled texts are counted over the whole table; the models are fitted on about ``secret_docs`` of them and
    ``ordinary_docs`` of all texts. Each row of transitions is smoothed by ``BACKOFF`` draws from the frequencies
    of single characters.
    """
    texts = docs.select("text").filter("text <> ''")
    size = texts.agg(F.count("*").alias("n"), F.count_if(F.col("text").rlike(_LABELLED)).alias("labelled")).first()
    labelled = _sample(texts, secret_docs, size["labelled"], _LABELLED)
    value = lambda s: F.when(
        s["kind"] == "assign", F.regexp_extract(s["value"], _ASSIGN, 1)
    ).otherwise(s["value"])
    secret = labelled.select("draw", F.explode(F.transform(base_spans(F.col("text")), value)).alias("t"))
    short = _sample(texts, ordinary_docs, size["n"]).withColumn("text", F.substring("text", 1, SAMPLE_CHARS))
    outside = short.withColumn("base", base_spans(F.col("text"))).withColumn("text", blanked(F.col("text"), F.col("base")))
    ordinary = outside.select("draw", F.explode(F.regexp_extract_all("text", F.lit(_ORDINARY), F.lit(0))).alias("t"))
    counts = []
    for tokens, alone in ((secret, True), (ordinary, False)):
        pairs = tokens.select("draw", F.explode(_transitions(_codes(F.substring("t", 1, SAMPLE_CHARS)))).alias("p"))
        seen = pairs.groupBy("p").agg(F.count("*").alias("n"), (F.min("draw") < F.max("draw")).alias("shared"))
        # An ordinary transition stands in two texts at least; a secret outside the patterns stands in one.
        counts.append({r["p"]: r["n"] for r in seen.filter(F.col("shared") | F.lit(alone)).collect()})
    logs = []
    for count in counts:
        rows = [sum(count.get(a * SYMBOLS + b, 0) for b in range(SYMBOLS)) for a in range(SYMBOLS)]
        ends = [sum(count.get(a * SYMBOLS + b, 0) for a in range(SYMBOLS)) + 0.5 for b in range(SYMBOLS)]
        chance = [e / sum(ends) for e in ends]
        logs.append(
            [
                math.log((count.get(a * SYMBOLS + b, 0) + BACKOFF * chance[b]) / (rows[a] + BACKOFF))
                for a in range(SYMBOLS)
                for b in range(SYMBOLS)
            ]
        )
    return [a - b for a, b in zip(*logs)]


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a printable token, summed over its transitions."""
    # One literal that the optimiser folds into an array.
    folded = F.split(F.lit(",".join(f"{x:.4f}" for x in table)), ",").cast("array<double>")
    return F.aggregate(_transitions(_codes(token)), F.lit(0.0), lambda acc, p: acc + F.get(folded, p))


def find_secrets(
    docs: DataFrame, threshold: float = THRESHOLD, table: list[float] | None = None, shortest: int = SHORTEST
) -> DataFrame:
    """All documents with ``base`` and ``spans`` (base and random) by start, and the ``clean`` text.

    Spans of kind ``random`` are tokens of ``shortest`` characters or more, or
    what the base spans leave of them. In ``clean`` every span reads <SECRET>. A
    null text counts as empty and has no spans; rows are treated one by one, so
    ids can be null or repeat. All columns of ``docs`` are kept; one that is
    called ``base``, ``spans`` or ``clean`` raises ValueError. Without labelled
    secrets the random model is uniform.
    """
    clash = {"base", "spans", "clean"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns to be added exist already: {sorted(clash)}")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    filled = docs.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    table = table or train(filled)
    found = filled.withColumn("base", base_spans(F.col("text")))
    found = found.withColumn("left", blanked(F.col("text"), F.col("base")))
    is_random = lambda t: ratio(t, table) > threshold
    pattern = _TOKEN % shortest
    # Places are worked out in the few texts that hold such a token.
    held = F.exists(F.regexp_extract_all("left", F.lit(pattern), F.lit(0)), is_random)
    placed = F.filter(find_spans(F.col("left"), pattern, RANDOM), lambda s: is_random(s["value"]))
    found = found.withColumn("random", F.when(held, placed).otherwise(no_spans()))
    spans = F.when(F.size("random") > 0, _by_start(F.concat("base", "random"))).otherwise(F.col("base"))
    found = found.withColumn("spans", spans.cast(f"array<{SPAN}>"))
    found = found.withColumn("clean", replaced(F.col("text"), F.col("spans"), lambda s: F.lit("<SECRET>")))
    return found.select("row.*", "base", "spans", "clean")


def secrets_digest(docs: DataFrame) -> DataFrame:
    """Counts and spans per document: (doc_id, n_*, base_sha256, spans)."""
    found = find_secrets(docs.select("doc_id", "text"))
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
