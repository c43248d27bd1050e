"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (dialogue, fixity, html_text, langid, lexical, licences, mixing, packing, pii, piecewise, simhash, topk,
               toxicity)
from .common import read, save


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.predict(docs, model)
    return got.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op2_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op3_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.fingerprints_with_next(read(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = save(topk.whole_vectors(read(spark, sf_dir, "embeddings")), "topk-vectors")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.digest(F.col("fp")).alias("fingerprint"), "component_id")


def op7_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = save(fixity.page_archives(read(spark, sf_dir, "pages")), "fixity-records")
    return fixity.audit(fixity.leaves(fixity.as_records(first)),
                        fixity.leaves(fixity.as_records(fixity.damaged(first))))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out(F.col("doc_id"))))
    got = toxicity.predict(docs, model)
    return got.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    index = licences.Index(*licences.frequencies(docs, licences.vocabulary()))
    return licences.scan(docs, index).drop("spans")


def op11_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(read(spark, sf_dir, "documents")))


def op12_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair(dialogue.damaged(read(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_language_id,
    op2_hilbert_packing,
    op3_piecewise_fingerprints,
    op4_html_text,
    op5_exact_top_k,
    op6_simhash_near_dedup,
    op7_merkle_fixity,
    op8_mix_sources,
    op9_toxicity,
    op10_licence_scan,
    op11_bootstrapped_pii,
    op12_max_sketch_search,
    op13_conversation_repair,
)}
ORACLES = {
    "op5_exact_top_k": topk.ORACLE_SQL,
    "op7_merkle_fixity": fixity.ORACLE_SQL,
    "op8_mix_sources": mixing.ORACLE_SQL,
    "op12_max_sketch_search": lexical.ORACLE_SQL,
    # base counts only need words and phrases, but labels of the method's own need its index: no SQL for op10
}

__all__ = ["ORACLES", "QUERIES"]
