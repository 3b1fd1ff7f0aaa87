"""Raw documents to packed training windows: quality, toxicity, exact copies, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm.exact_dedup import drop_copies
from leadloom.llm.ngram_join import PERCENT
from leadloom.llm.packing import packed_digest
from leadloom.llm.quality import score_quality
from leadloom.llm.scratch import materialize, rows_of, table
from leadloom.llm.simhash import near_duplicates
from leadloom.llm.toxicity import drop_toxic, learn


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null, empty and very short texts go."""
    return score_quality(docs, carry=True).where("kept").select("_row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, under a model learned from the labels of documents that came so far."""
    return drop_toxic(docs, learn(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the longest original, then the smallest doc_id; of rows that repeat both, one."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of linked fingerprints; rows that share an id share its fate."""
    return _first_of_groups(docs, near_duplicates(docs))


def edited_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As near_copies, with texts linked too whose sets of five-word shingles have a Jaccard similarity of 0.8 or more: all such pairs."""
    return _first_of_groups(docs, near_duplicates(docs, similar=PERCENT / 100))


def _first_of_groups(docs: DataFrame, groups: DataFrame) -> DataFrame:
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    joined = rows_of(docs).join(kept, F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return joined.select("_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their windows."""
    return packed_digest(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", edited_copies),
    ("packing", packing),
]

#: SQL cannot express the learned filter, the fingerprints or the tokenizer; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
