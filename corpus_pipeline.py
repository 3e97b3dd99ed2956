"""A corpus pipeline over documents: toxicity, exact dedup, near-duplicate join, decontamination, tokens.

In every stage but the last, all columns of its input come out as they were, whatever their names.  Null and empty texts
are kept by toxicity (unless the bias alone rejects them) and decontamination, are copies of one another to exact dedup,
and near copies of nothing.  Rows of a null id, and rows that repeat an id, are judged each by their own text, but for the
near-duplicate join, where an id is one document and a null id stays.  Ties go by id, then by the other columns.  Empty
tables give empty results, without labels nothing is toxic, without a benchmark nothing is contaminated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from skyledger.llm._spark import delete, shared_dir, table
from skyledger.llm.queries import vocabulary
from skyledger.session import ship


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by a model trained on the labels; no shuffle of the texts."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), ship(spark))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: that of the largest id; a null id is the least."""
    return exact_dedup.drop_copies(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity of 0.8 or more): that of the smallest id."""
    return jaccard_join.keep_one(docs, ship(spark), pct=80, size=5)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), ship(spark))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document; null and empty texts have no ids."""
    ship(spark)
    return bpe.bpe_round_trip(docs, vocabulary(), keep=("ids",))


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("ngram_jaccard_join", near), ("decontamination", clean), ("bpe", tokens)]

# A trained classifier and a tokenizer are among the stages: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each result is written to the shared folder and read again, and deleted when the next is there."""
    docs = table(spark, sf_dir, "documents")
    base, before = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
