"""Personal data: patterns, and terms that give protected entities away.

Emails, addresses of machines, cards and phone numbers are found by patterns;
their values are the protected entities. Over the whole corpus, the texts that
hold a term and mention an entity are counted, and so are those of every term
and of every entity; copies of a text that mentions an entity count once. What is judged is not the
estimate of P(c | t), the probability of entity c where term t stands, but its
lower credible bound L (Wilson's, with ``doubt`` as the squared number of
standard deviations), as very many words are tried:

    what the term leaves to be known      h(c | t) = -log2 L  <=  bits,
    what it discloses       log2(L N / n_c)  >=  share * log2(N / n_c).

The first does not depend on the size of the corpus, the second keeps common
words from disclosing an entity that many texts mention. The bound asks for
three texts without exception, or more with some. An entity of fewer texts is
given away by a word written like a name that stands nowhere but with the entity.
Terms that occur in no document without the entity are removed, others
generalised. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrella.llm.common import materialize
from terrella.llm.spans import blanked, count_kind, find_spans, joined, no_spans, replaced

KINDS = ("email", "ip", "card", "phone")
TERM, REMOVED = "term", "removed"
#: Information about an entity, in bits, that must stay unknown where a term stands.
BITS = 2.0
#: Share of an entity's information that a term may not disclose.
SHARE = 0.5
#: Squared standard deviations between an estimate and its credible bound.
DOUBT = 8.0
#: Buckets of terms: so many numbers (16 bytes each) are broadcast at most.
BUCKETS = 1 << 22
_KEYS = ("_pii_1", "_pii_2")
#: Two hashes of the text alone.
_TEXT = ("_pii_2", "_pii_3")

# Possessive forms of the patterns. A match can only start at the border of a
# run or where the last match ended, so no run is searched twice.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_WORD = r"[^\p{L}]+"
# A word with a capital: inside a sentence, and anywhere.
_INSIDE = r"(?<=[\p{L}\p{N},;:]\x20)\p{Lu}\p{L}*+"
_CAPITAL = r"(?<!\p{L})\p{Lu}\p{L}*+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Luhn's check sum, counted from the right."""
    doubled = F.translate(digits, "0123456789", "0246813579")
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        source = F.when(i % 2 == 0, digits).otherwise(doubled)
        return total + F.substring(source, size - i, F.lit(1)).cast("int")

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of all kinds, by kind and then start."""
    email = F.when(F.contains(text, F.lit("@")), find_spans(text, _EMAIL, "email")).otherwise(no_spans())
    digit = text.rlike("[0-9]")
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), find_spans(text, _IP, "ip")).otherwise(no_spans())
    ip = F.filter(ip, lambda s: s["value"].rlike(rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z"))
    card = F.when(digit, find_spans(text, _CARD, "card")).otherwise(no_spans())
    card = F.filter(
        card,
        lambda s: F.when(F.length(_digits(s["value"])).between(13, 19), passes_luhn(_digits(s["value"]))).otherwise(
            F.lit(False)
        ),
    )
    phone = F.when(text.rlike(r"\+[0-9]"), find_spans(text, _PHONE, "phone")).otherwise(no_spans())
    phone = F.filter(phone, lambda s: F.length(_digits(s["value"])).between(9, 15))
    return F.concat(email, ip, card, phone)


def _words(text: Column) -> Column:
    """Distinct words as they are written."""
    return F.filter(F.array_distinct(F.split(text, _WORD)), lambda w: w != "")


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.lower(span["value"]))


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS))


def _names(text: Column) -> Column:
    """Words written like names: with a capital inside a sentence, or with one twice; in lower case."""
    found = F.array_sort(F.regexp_extract_all(text, F.lit(_CAPITAL), F.lit(0)))
    twice = F.filter(F.zip_with(found, F.slice(found, F.lit(2), F.size(found)), lambda a, b: F.when(a == b, a)), lambda w: w.isNotNull())
    return F.transform(F.array_union(F.regexp_extract_all(text, F.lit(_INSIDE), F.lit(0)), twice), F.lower)


def lower_bound(hits: Column, tries: Column, doubt: float) -> Column:
    """Wilson's lower bound of a share seen ``hits`` times in ``tries``."""
    share = hits / tries
    spread = F.sqrt(doubt * (share * (1 - share) / tries + doubt / (4 * tries * tries)))
    return (share + doubt / (2 * tries) - spread) / (1 + doubt / tries)


def disclosing_terms(docs: DataFrame, bits: float, share: float, doubt: float) -> DataFrame:
    """(term, action) of the terms that disclose too much of any entity.

    ``docs`` has the two hashes of ``_TEXT``, ``seen``, the text without its
    mentions, and ``entities``, the distinct entities mentioned. Counts are made
    over all documents, and added up before each shuffle. Entities of the same
    texts are counted as one, as all their counts are equal.
    """
    total, least = docs.count(), 2.0**-bits
    lower = lambda words: F.array_distinct(F.transform(words, F.lower))
    terms = docs.select(F.explode(lower(_words(F.col("seen")))).alias("term"))
    terms = terms.groupBy("term").agg(F.count("*").alias("n_t"))
    mentions = docs.filter(F.size("entities") > 0).groupBy(*_TEXT).agg(
        F.first("entities").alias("entities"), F.first("seen").alias("seen"), F.count("*").alias("copies")
    )
    mentions = materialize(mentions.withColumn("names", _names(F.col("seen"))), "mentions")
    each = mentions.select(*_TEXT, "copies", F.explode("entities").alias("entity"))
    alike = [F.bit_xor(k).alias(f"_of{k}") for k in _TEXT]
    sets = each.groupBy("entity").agg(F.count("*").alias("n_c"), F.sum("copies").alias("d_c"), *alike)
    group = ["n_c", "d_c", *(f"_of{k}" for k in _TEXT)]
    groups = materialize(each.join(sets, "entity").select(*_TEXT, *group).distinct(), "entities")

    # No bound exceeds its estimate: a term of more documents than this discloses nothing of the entity.
    most = F.col("n_c") / least + F.col("d_c") - F.col("n_c")
    tops = groups.groupBy(*_TEXT).agg(F.max(most).alias("_top"))
    words = F.explode(lower(_words(F.col("seen")))).alias("term")
    held = mentions.join(tops, list(_TEXT)).select(*_TEXT, "copies", "_top", "names", words)
    held = held.withColumn("name", F.array_contains("names", F.col("term"))).drop("names")
    rare = held.join(terms, "term").filter(F.col("n_t") <= F.col("_top")).drop("_top")
    pairs = rare.join(groups, list(_TEXT)).filter(F.col("n_t") <= most)
    counted = pairs.groupBy("term", "n_t", *group).agg(
        F.count("*").alias("n_ct"), F.sum("copies").alias("d_ct"), F.max("name").alias("name")
    )
    only = F.col("d_ct") == F.col("n_t")
    tries = F.col("n_t") - (F.col("d_ct") - F.col("n_ct"))
    bound, common = lower_bound(F.col("n_ct"), tries, doubt), F.col("d_c") / total
    # Some bits are lost to rounding where both sides are equal.
    known = (F.log2(bound) >= -bits - 1e-9) & (F.log2(bound / common) >= -share * F.log2(common) - 1e-9)
    few = F.col("n_c") / (F.col("n_c") + doubt) < least
    discloses = (common < 1) & (known | few & only & F.col("name"))
    return counted.filter(discloses).groupBy("term").agg(F.when(F.max(only), REMOVED).otherwise(TERM).alias("action"))


def find_personal_data(
    docs: DataFrame, bits: float = BITS, share: float = SHARE, doubt: float = DOUBT
) -> DataFrame:
    """All documents with ``base`` and ``spans`` (base, then terms) and the sanitised ``clean`` text.

    Term spans cover every occurrence, in any document, of a term that discloses
    an entity, wherever that is mentioned; those that touch a base span are left
    out. In ``clean`` base spans read <EMAIL> and so on, generalised terms
    <TERM>, and removed terms nothing. A null text counts as empty. Full copies
    of a row are treated alike; ``doc_id`` can be null
    or repeat. All columns of ``docs`` are kept; they must not be called
    ``base``, ``spans`` or ``clean``, nor start with ``_pii``.
    """
    columns = docs.columns
    keyed = docs.withColumn("_pii_text", F.coalesce("text", F.lit("")))
    keyed = keyed.withColumn("base", base_spans(F.col("_pii_text")))
    keyed = keyed.withColumn("_pii_1", F.xxhash64("doc_id", "_pii_text")).withColumn(
        "_pii_2", F.xxhash64("_pii_text", F.lit("second"))
    )
    seen = keyed.select(
        *_KEYS,
        F.xxhash64("_pii_text", F.lit("third")).alias("_pii_3"),
        blanked(F.col("_pii_text"), F.col("base")).alias("seen"),
        F.array_distinct(F.transform("base", _entity)).alias("entities"),
    )
    disclosing = materialize(disclosing_terms(seen, bits, share, doubt), "disclosing")
    # Words whose bucket no term is in are left out before the shuffle; buckets have a bound, terms have none.
    taken = F.broadcast(disclosing.select(_bucket(F.col("term")).alias("bucket")).distinct())
    held = seen.select(*_KEYS, F.explode(_words(F.col("seen"))).alias("word")).withColumn("term", F.lower("word"))
    held = held.join(taken, _bucket(F.col("term")) == F.col("bucket"), "left_semi")
    hits = held.join(disclosing, "term")
    hits = hits.groupBy(*_KEYS).agg(
        F.collect_set("word").alias("_pii_words"),
        F.collect_set(F.when(F.col("action") == REMOVED, F.col("word"))).alias("_pii_gone"),
    )
    marked = keyed.join(materialize(hits, "term-hits"), list(_KEYS), "left")

    # Words as they are written have letters only and match as a whole, so their order does not matter.
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join("_pii_words", "|"), F.lit(r")(?!\p{L})"))
    spans = find_spans(blanked(F.col("_pii_text"), F.col("base")), pattern, TERM)
    kind = lambda s: F.when(F.array_contains("_pii_gone", s["value"]), REMOVED).otherwise(TERM)
    spans = F.transform(spans, lambda s: s.withField("kind", kind(s)))
    marked = marked.withColumn(
        "spans", F.when(F.col("_pii_words").isNull(), F.col("base")).otherwise(F.concat("base", spans))
    )

    def by(span: Column) -> Column:
        return F.when(span["kind"] == REMOVED, "").otherwise(F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">")))

    marked = marked.withColumn("clean", replaced(F.col("_pii_text"), F.col("spans"), by))
    return marked.select(*columns, "base", "spans", "clean")


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts and spans per document: (doc_id, n_*, base_sha256, spans)."""
    found = find_personal_data(docs.select("doc_id", "text"))
    counts = [count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
