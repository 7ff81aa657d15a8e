"""Cleaning a corpus in five stages: toxicity, exact copies, near copies, benchmark passages, token ids and
what they decode to.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared
checkpoint folder and read again as the next stage's ``docs``; after a lost executor or a failed stage
nothing before it is computed again.  All but the last return the columns of ``docs``.

A row is named by its id and its text together, so ids may be null or repeated.  Null texts are
empty ones; an empty table passes through all stages; extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folio.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from folio.llm.common import scratch, table

#: A trained classifier and alignment scores are not expressible in SQL; tests compare with plain Python.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on labelled documents outside the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest stays, then the one with the least id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more (five-word shingles) the one with the least id stays."""
    return jaccard_join.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text that they decode to: (doc_id, n_tokens, ids, decoded)."""
    import public_tokenizers
    vocabulary = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.encode(docs.select("doc_id", "text"), vocabulary).select("doc_id", "n_tokens", "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
