"""A training corpus from raw documents: five stages, each one of the numbered operators.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and gives a DataFrame
that is written as Parquet and read again as the next one's ``docs``. All but the last give documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from candela.llm.common import ship, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores at its threshold or above go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents, the one with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document that is left."""
    return bpe.bpe_digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("BPE encoding", encode),
]

#: SQL cannot express the classifier, the seeded choice or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``.

    Each stage says what becomes of null and empty texts, ties, repeated rows and rows without an id; columns that
    are not its own pass through, and an empty table gives an empty result."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
