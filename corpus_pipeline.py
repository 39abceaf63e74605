"""Corpus pipeline: documents -> quality rules -> toxicity -> near duplicates ->
packed sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  Its result is
written as Parquet to the shared scratch folder and read again as the next
stage's ``docs``; all stages but the last return the columns of ``docs``.  A
document is judged by its row; rows with a null id cannot be joined to their
verdict and are rejected by the first stage, as are rows that differ under one
id when any of them is rejected.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.common import staged, table
from inkwell.llm.jaccard import near_duplicates
from inkwell.llm.packing import packed_sequences
from inkwell.llm.quality import quality_rules
from inkwell.llm.toxicity import toxicity


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base and the certified quality rules."""
    verdicts = quality_rules(docs, table(spark, sf_dir, "labels"))
    rejected = verdicts.where("not kept").select("doc_id").distinct()
    return docs.where("doc_id is not null").join(rejected, "doc_id", "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents with a toxicity score of a half or more."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    toxic = scored.where("score >= 0.5").select("doc_id").distinct()
    return docs.join(toxic, "doc_id", "left_anti").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the
    smallest id, once if its row repeats.  Texts that differ under one id are
    documents of their own, and of those in one group the first by a hash stays."""
    nodes = docs.withColumn("_node", F.xxhash64("doc_id", "text"))
    groups = near_duplicates(nodes.select(F.col("_node").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_node"), "component_id").distinct()
    kept = (groups.join(nodes.select("_node", "doc_id").distinct(), "_node").groupBy("component_id")
            .agg(F.min(F.struct("doc_id", "_node")).alias("first")).select("first._node"))
    return nodes.join(kept, "_node", "left_semi").dropDuplicates(["_node"]).select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: its sequence and its place there."""
    return packed_sequences(docs)


STAGES = [
    ("quality_rules", drop_low_quality),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("best_fit_packing", pack_documents),
]

#: The conditional random field and the local search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
