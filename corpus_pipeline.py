"""Corpus pipeline: documents to a training order, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame that is written as Parquet and reread as the
next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import decontam, jaccard, langid, mixing, pii
from sitelens.llm.queries import PII_SECRET
from sitelens.llm.staging import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: null texts, texts without a
    letter and texts that random letters explain as well go. The model is
    learned from the labelled rows of ``docs``; without any, only the first
    two kinds go."""
    return langid.keep_identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest
    key. Of repeated rows one stays; a key with several texts goes if all of
    them belong to groups of smaller keys; rows without a key stay."""
    found = jaccard.component_ids(docs.select("doc_id", "text"))
    keys = found.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("goes"),
                                       F.count(F.lit(1)).alias("n"))
    keys = staged(keys.filter("goes OR n > 1"), "duplicates")
    gone = keys.filter("goes").select("doc_id")
    small = gone.count() <= jaccard.BROADCAST_ROWS
    kept = docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti")
    if keys.filter("NOT goes AND doc_id IS NOT NULL").take(1):
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts pseudonymised;
    ``n_chars`` counts the new text where it changed."""
    kinds = pii.unused("__kinds", docs.columns)
    marked = pii.pseudonymise(docs, PII_SECRET, found=kinds)
    n = F.when(F.size(kinds) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return marked.withColumn("n_chars", n).select(*docs.columns)


def mixing_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: one row for each document and pass that takes of
    it, sorted by position."""
    return mixing.mixture(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("mixing", mixing_order),
]

#: SQL expresses neither the language model nor the keyed pseudonyms; the
#: stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
