"""A corpus from raw documents to training windows, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Between stages the documents are a Parquet
table in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsloom.llm import line_rules, packing, secrets, simhash, subword_classifier
from newsloom.llm.shared import written


def _measured(docs: DataFrame) -> DataFrame:
    """`n_chars` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the subword classifier accepts."""
    model = subword_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return subword_classifier.accepted(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that too many documents of a source share, and documents that fail the rules."""
    return _measured(line_rules.cleaned(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose fingerprints (three-word shingles) link at two bits."""
    return simhash.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets, and say which are examples that many owners have."""
    return _measured(secrets.masked(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training windows, with their token ids."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

# Learned and hashed stages have no SQL; tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the documents in `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
