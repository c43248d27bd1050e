"""From documents to packed sequences: five stages, each over all that the last one kept.

``run`` chains them; each stage's result is written in the shared folder and
read again, so a stage's work is never repeated by a later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import langid, mixing, packing, simhash, toxicity
from riskloom.llm.common import read, save

MEMO = 400_000  # pieces whose ids a worker keeps: less than op2's, as executors have run other stages before


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a language's centroid."""
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.filter_language(docs, model)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    labels = read(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.filter_toxic(docs, toxicity.train(docs, labels))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the smallest number."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece of a document in a sequence."""
    return packing.pack_documents(docs, memo=MEMO)


STAGES = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("near_copies", one_of_near_copies),
    ("mix", mixed),
    ("pack", packed),
]

# Classifiers and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = save(docs, f"pipeline-{name}")
    return docs
