"""A corpus pipeline over ``documents``: each stage works on all rows that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written to the folder that all executors share
and read again as the next stage's input, so no stage is computed twice and lost executors cost one stage's tasks only.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiomill.llm.decontaminate import without_items
from curiomill.llm.minhash import near_duplicates
from curiomill.llm.packing import pack_documents
from curiomill.llm.quality import keep_good
from curiomill.llm.secrets import redacted
from curiomill.llm.tables import kept, table

SHINGLE = 5  # words
SIMILAR = 80  # percent


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: that with the smallest id, ids before nulls.

    Rows are told apart by a number that is written with them, not by their ids: rows that share an id and hold
    different texts are different documents, and rows without an id are compared like all others.
    """
    number = next(c for c in (f"row_number_{i}" for i in range(len(docs.columns) + 1)) if c not in docs.columns)
    rows = kept(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(rows.select(number, "text"), id_col=number, shingle=SHINGLE, percent=SIMILAR)
    ids = groups.join(rows.select(number, "doc_id").hint("merge"), number)
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", number)).alias("first"))
    return rows.join(first.select(f"first.{number}").hint("merge"), number, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace the secrets in the texts; every document stays."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place all documents into sequences of permitted lengths: one row for each piece."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("packing", packing)]

ORACLE_SQL: str | None = None  # trained models and signatures; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
