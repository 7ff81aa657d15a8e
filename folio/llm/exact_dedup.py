"""Exact deduplication against a persistent digest index (DataFrame operations only).

The index is a table bucketed and sorted by the digest of the normalised text, one row per
distinct text: digest, the row that stands for it (``keep_id``), its length and how many rows the
batch that brought it had.  A new batch is reduced to one row per digest (map-side first),
anti-joined with the index by sort-merge, and what is new is appended.  The index side
of that join is read in bucket order and is not shuffled.

Texts are equal when identical after deleting the characters of ``[\\x20\\x09-\\x0D]``.
In a batch the row with the most code points in its original text stays, then the smallest id.
A text that an earlier batch brought keeps that batch's row: it has been handed out.

Defined results: a null text counts as empty; all empty texts are one group; a null id
sorts last; an empty batch leaves the index as it is; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import WHITE, keep, keep_rows

INDEX_SCHEMA = "digest binary, keep_id long, keep_chars long, group_size long, batch string"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.length(body).cast("long").alias("chars"),
                       F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)).alias("digest"), F.xxhash64(body).alias("text_hash"))


class DigestIndex:
    """A bucketed table of digests; ``name`` is a table name of the session's catalogue."""

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.tableExists(self.name):
            self._append(spark.createDataFrame([], INDEX_SCHEMA))

    def _append(self, rows: DataFrame) -> None:
        # one file per bucket and batch: rows are dealt by the hash that also names the bucket
        (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, keyed: DataFrame, batch: str | None = None) -> str:
        """Append the batch's digests that the index lacks; returns the batch's name.

        ``keyed``: rows of ``digests``.  A hot text is one row per map task before the
        shuffle, so a third of all rows in one group is no load.  A batch that is
        added again finds all its digests in the index and appends nothing.
        """
        batch = batch or uuid.uuid4().hex
        best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
        texts = (keyed.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
                 .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"),
                         "group_size", F.lit(batch).alias("batch")))
        new = texts.hint("merge").join(self.read().select("digest"), "digest", "left_anti")
        self._append(new)
        self.spark.catalog.refreshTable(self.name)
        return batch

    def judge(self, keyed: DataFrame, batch: str) -> DataFrame:
        """Every row of the batch with the row that stands for its text.

        The index's files are read as plain files here: both sides are then shuffled on
        the digest and Spark splits the tasks of a hot digest (skew join), which it
        cannot do for a bucketed side.
        """
        path = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").where("col_name = 'Location'").first()["data_type"]
        index = self.spark.read.schema(INDEX_SCHEMA).parquet(path)
        own = F.col("batch") == F.lit(batch)
        return (keyed.join(index, "digest")
                .select("doc_id", "keep_id", F.when(own, F.col("group_size")).otherwise(F.lit(None)).alias("group_size"),
                        (own & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"), "text_hash"))


def dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Judge all rows of ``docs`` as one new batch against ``index`` (a new, empty one by
    default).  ``group_size`` counts the batch's rows of that text; it is null for a text that
    an earlier batch brought.  Rows that repeat an id with the same text are all kept or
    all dropped here; ``drop_copies`` leaves one."""
    index = index or DigestIndex(docs.sparkSession)
    keyed = keep(digests(docs), "digests")
    batch = index.add(keyed)
    return index.judge(keyed, batch)


def drop_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, dedup(docs, index).select("doc_id", "text_hash", F.col("kept").alias("stays")))
