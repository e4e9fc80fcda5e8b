"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing to targets, packing.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame. `run` writes
every stage's result as Parquet to shared storage and reads it back as the next one's documents. All stages
but the last return the columns of `documents`.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import jaccard, mixing, packing, quality, substrings
from seqloom.llm.store import REST, rest_of, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Documents without words belong to no group and stay.
    """
    return jaccard.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their repeated passages; what has lost nothing keeps its text as it is."""
    cut = substrings.dedup_substrings(docs)
    lost = F.col("_n_removed") > 0
    made = {"text": F.when(lost, F.col("_kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        given = F.col(REST).getField("n_chars")
        made["n_chars"] = F.when(lost, F.length("_kept").cast(kind)).otherwise(given)
    return cut.select(*rest_of(docs.columns, ("text",), made))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]

#: Shingle sets' components, token ids and packings are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
