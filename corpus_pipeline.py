"""The corpus pipeline: documents go through STAGES, each written and read again.

Each stage takes all that its predecessor kept. All but the last return the columns of the
documents they are given, extra ones included; the last returns pieces with their places in
sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigscore.llm._common import materialise, table
from sigscore.llm.mixing import mix_documents
from sigscore.llm.near_dedup import near_duplicates
from sigscore.llm.packing import pack_documents
from sigscore.llm.substring_dedup import remove_repeats
from sigscore.llm.toxicity import THRESHOLD, scorer, train

# Word shingles of near-duplicate stages, and their least similarity in percent.
NEAR_SHINGLE_WORDS, NEAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic. The model learns from ``labels`` and these documents."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(scorer(model)("text").getField("score") < THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id. Rows
    that share the id stay if their texts differ; equal ones are one. Rows without an id stay."""
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), "text")
    named = row.where(F.col("id").isNotNull())
    digest = F.coalesce(F.md5("text"), F.lit(""))
    several = named.groupBy("id").agg(F.min(digest).alias("s"), F.max(digest).alias("t")).where("s < t")
    if several.isEmpty():
        named = named.withColumn("node", F.col("id"))
    else:
        # ids with several texts: each text is a document of its own, numbered in the order of ids
        named = named.withColumn("digest", digest)
        numbers = materialise(named.select("id", "digest").distinct().orderBy("id", "digest").withColumn(
            "node", F.monotonically_increasing_id()), "near_nodes")
        named = materialise(named.join(numbers, ["id", "digest"]).select("row", "id", "text", "node"),
                            "near_named")
    found = near_duplicates(named.select(F.col("node").alias("doc_id"), "text"), NEAR_SHINGLE_WORDS,
                            NEAR_PERCENT)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    kept = named.join(gone, F.col("node") == F.col("gone"), "left_anti")
    once = kept.dropDuplicates(["id", "text"]).select("row.*")
    return once.unionByName(row.where(F.col("id").isNull()).select("row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that also stand in a document with a smaller id. A document of which
    nothing is left goes; documents that were empty before stay."""
    return remove_repeats(docs, drop_emptied=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sources to their target weights; a document drawn twice is there twice."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mixing", mixing), ("packing", packing)]
ORACLE_SQL = None  # learned scores and token ids are beyond SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
