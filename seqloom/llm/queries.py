"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer_path

from seqloom.llm import (
    centroids, extraction, fingerprints, infill, jaccard, licenses, lm, mixing, packing, quality, substrings, suffixes, urls,
)
from seqloom.llm.registry import QUERIES, query, table
from seqloom.llm.store import REST

__all__ = ["QUERIES"]


@query("op1_mixing_sources", mixing.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.with_copies(docs)
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup_substrings(docs).select(
        F.col(REST).getField("doc_id").alias("doc_id"),
        F.col("_n_units").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("_row")


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.cross_entropy_difference(docs, lm.labelled_target(docs, table(spark, sf_dir, "labels")))


@query("op5_document_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_edits(table(spark, sf_dir, "documents"))


@query("op6_quality_rules", quality.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return judged.select(F.col("_key").alias("doc_id"), *quality.COUNTS, "base_failed", "kept")


@query("op7_url_filters")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.dedup_bytes(docs).select(
        F.col(REST).getField("doc_id").alias("doc_id"),
        F.col("_n_units").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op10_license_scans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / language / hundred of ids / id."""
    docs = table(spark, sf_dir, "documents")
    parts = [F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.floor(F.col("doc_id") / 100).cast("string"), "doc_id"]
    return licenses.scan_licences(docs.select("doc_id", F.concat_ws("/", *parts).alias("path"), "text"))


@query("op11_infill", infill.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infill(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        F.col(REST).getField("doc_id").alias("doc_id"),
        F.col("_n").alias("n"),
        F.col("_form").alias("form"),
        F.col("_prefix_chars").alias("prefix_chars"),
        F.col("_middle_chars").alias("middle_chars"),
        F.sha2("_output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("_output"), F.col("_form")), 256).alias("restored_sha256"),
    )


@query("op12_centroid_clustering", centroids.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        F.col(REST).getField("vec_id").alias("vec_id"),
        F.col("_near").alias("cluster"),
        F.col("_distance").alias("distance"),
        F.col("_cluster_inertia").alias("cluster_inertia"),
        F.col("_inertia").alias("inertia"),
        F.sha2(F.array_join(F.col("_centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


@query("op13_html_extraction")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return made.select(
        F.col(REST).getField("page_id").alias("page_id"),
        F.col(REST).getField("url").alias("url"),
        F.col("_text").alias("text"),
        F.length("_text").cast("long").alias("n_chars"),
    )
