"""A training corpus from raw documents: five stages, each on all that the one before it kept.

Rows that a stage returns are written as Parquet to the shared folder and read
again, so a lost executor repeats a part of one stage only. All stages but the
last return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import common, langid, minhash, packing, pii, quality_rules, toxicity


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the quality fences of their language and source."""
    return quality_rules.filter_documents(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted as toxic; the folds of op8_toxicity hold for learning."""
    labels = common.table(spark, sf_dir, "labels").filter(langid.fold(5) != 0)
    return toxicity.filter_documents(docs, labels)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return minhash.filter_documents(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data under pseudonyms with the key of the session's settings."""
    return pii.pseudonymize_documents(docs, pii.secret_key(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; small dictionaries, as earlier stages hold memory too."""
    return packing.pack_documents(docs, max_words=90_000, rows_at_once=300)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("minhash_near_dedup", near_dedup),
    ("pii", personal_data),
    ("best_fit_packing", pack),
]
#: Trained models and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.kept_table(stage(spark, docs, sf_dir))
    return docs
