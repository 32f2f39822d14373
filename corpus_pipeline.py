"""Corpus pipeline: documents in, token digests out, one operator per stage.

Every stage takes (spark, docs, sf_dir), works on all rows that its
predecessor kept and returns a DataFrame; all but the last return the columns
of documents. Stage outputs are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotledger.llm import bpe, decontaminate, language, ngram_join, pii
from lotledger.llm.queries import QUERIES
from lotledger.session import materialize

# Documents whose best language has a lower pooled probability are rejected.
LEAST_LANGUAGE_SCORE = 0.3
# Near duplicates: words per shingle, similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose language cannot be told: none, without letters, or too uncertain."""
    return language.keep_identified(docs, language.fit(docs), LEAST_LANGUAGE_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked texts stays, that of the smallest id."""
    return ngram_join.deduplicate(docs, size=SHINGLE_WORDS, percent=SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal spans in every text by marks of their kind; ``n_chars`` follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text that is left."""
    return bpe.digest(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("byte-level BPE", encode_tokens),
]
# A trained network and boosted trees decide what stays: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES["pipeline"] = run
