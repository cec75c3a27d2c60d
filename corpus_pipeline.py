"""The corpus pipeline: documents in, packed sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
it kept; all but the last return the columns of ``documents``.  ``run`` writes
each stage's result as Parquet to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editpulse.llm import common, jaccard, packing, suffixindex, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject."""
    return toxicity.without_toxic(docs, common.read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    return jaccard.one_of_each_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that also start earlier; one
    left empty stays, as an empty document."""
    return suffixindex.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("suffix_array", cut_repeats), ("packing", pack_sequences)]

#: The toxicity model is fitted, which SQL cannot express; tests/llm compares the
#: pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.staged(spark, docs, f"pipeline-{name}")
    return docs
