"""A corpus pipeline over the given documents: each stage works on what the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from chainfold.llm import digests, mixing, simhash, templates, toxicity
from chainfold.llm.common import query, table
from chainfold.session import shared_folder


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: the classifier chain is fitted on the labelled documents that are there; what it rejects goes."""
    return toxicity.keep_harmless(docs, toxicity.fit(docs, toxicity.given_labels(spark, sf_dir)))


def exact_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the document with the smallest id stays."""
    return digests.keep_first(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: of each group of near copies (five-word shingles, similarity 0.8) one document stays."""
    return simhash.keep_one(docs)


def leaks_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a benchmark item, also one with other numbers or names, go."""
    return templates.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: sources are brought to the target entropy; the rows drawn carry epoch, block and draw_key."""
    return mixing.mixed_documents(docs)


STAGES = [("toxicity", toxic_documents_go), ("exact dedup", exact_copies_go), ("simhash near dedup", near_copies_go),
          ("benchmark decontamination", leaks_go), ("mixing to target weights", mixed)]

# The first stage fits a classifier, which SQL cannot express; tests hold the stages against plain Python.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written to the shared folder and read back."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{number}")
    return docs
