"""The corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

``STAGES`` are applied in order; each takes ``(spark, docs, sf_dir)`` and
returns the documents it keeps with their columns, the last one the packed
pieces. Every stage is written as Parquet and read again as the next one's
input, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regwise.llm import near_copies, packing, pseudonyms, quality, repeats
from regwise.llm.common import Cut, table
from regwise.llm.queries import pseudonym_key


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule of the current policy rejects go; a null text has no words and is rejected."""
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document of the smallest doc_id stays.

    Fingerprints found by the Gray-order index and MinHash bands propose, whole sets of shingles decide. A row without
    an id stays only where no row of its group has one.
    """
    return near_copies.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that start earlier in the corpus go; ``n_chars`` follows. A null text becomes empty; rows of one doc_id come in order of their texts."""
    return repeats.remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of their own format; ``n_chars`` follows. A null text stays null."""
    new = pseudonyms.pseudonymise(docs, pseudonym_key(spark))
    return new.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else new


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids; a null text is one end id."""
    pieces = packing.sequences(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("repeated passages", repeated_passages),
          ("personal data", personal_data), ("packing", packed)]
# Fingerprints, suffix arrays, keyed permutations and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Cut(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return docs
