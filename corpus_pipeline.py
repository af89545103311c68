"""The corpus pipeline: language ID, quality rules, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of
``documents``.  run() writes each stage's rows as Parquet into the shared folder and reads them again; the rows of the stage
before go when they have been read.

For every stage: an empty table gives an empty table, repeated rows are rows of their own (near-dedup keeps one), extra columns
stay as they are whatever their names (packing leaves them out), and a null doc_id is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, packing, quality, secret_scan, simhash
from tidemark.llm.common import read, remove, spilled

#: A document whose best language has a lower mean probability is rejected, as are those without a language.
LEAST_SCORE = 0.3
#: Documents as similar as this, or more, are near-duplicates.
SIMILARITY = 0.8
#: Workers of earlier stages are still there when packing runs, so it keeps fewer words in memory than a query of its own.
REMEMBERED = 60_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go (null texts and texts without a letter too); the rest keep their rows as they are.

    The model is fitted on a bounded sample of docs with a language; without any, all documents go.
    """
    return language_id.keep_recognised(docs, language_id.fit(docs), LEAST_SCORE)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy rejects go; null and empty texts are among them (too few words)."""
    return quality.filter_documents(docs, "strict-1")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (Jaccard similarity of five-word shingles 0.8 or more) the document with the least doc_id stays.

    Of rows with equal ids one stays, null ids come last; null and empty texts are copies of one another.
    """
    return simhash.keep_one(docs, similarity=SIMILARITY)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; n_chars follows the new text.  A null text stays null, with a null n_chars."""
    return secret_scan.redact(docs).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a sequence of at most 2048 tokens; a null text is its end token alone."""
    return packing.pack(docs, remembered=REMEMBERED)


STAGES = [
    ("language ID", identify_language),
    ("quality rules", apply_quality_rules),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]
#: A trained network and a tokenizer decide the rows: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs, path = spilled(stage(spark, docs, sf_dir), f"stage-{k}")
        if before:
            remove(spark, before)
        before = path
    return docs
