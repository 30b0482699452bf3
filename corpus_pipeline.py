"""A corpus from raw documents to packed sequences, in stages that can each be run and kept on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.llm import common, decontam, langid, near_dedup, packing, pii
from terrella.llm.queries import table, tokenizer

#: Columns that all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _those(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents whose id is among those of ``wanted``."""
    ids = wanted.select(F.col("doc_id").alias("_wanted")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_wanted"]), "left_semi").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognisable language: those predicted ``und`` go."""
    common.prepare(spark)
    found = langid.identify_language(docs)
    return _those(docs, found.filter(F.col("lang_pred") != langid.UNDETERMINED))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    common.prepare(spark)
    return _those(docs, near_dedup.near_duplicates(docs).filter("kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data generalised or removed."""
    common.prepare(spark)
    found = pii.find_personal_data(docs.select(*COLUMNS))
    changed = F.size("spans") > 0
    return found.select(
        "doc_id",
        F.when(changed, F.col("clean")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence."""
    common.prepare(spark)
    return packing.pack_documents(docs, *tokenizer())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: No stage but the patterns of the fourth can be put in SQL; tests/llm checks the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
