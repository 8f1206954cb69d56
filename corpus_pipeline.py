"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes
as Parquet to the shared scratch folder and reads again for the next stage. Folders that are
no longer read are deleted as it goes; at the end only the result's own is left.

Repeated rows and ties: language ID, quality rules and decontamination judge every row by itself.
Near-dedup keeps the row with the smallest id of a class (null last, then the smallest text hash; of
equal rows one). Packing places every row by itself, in order of length, id and piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourcast.llm import decontaminate, langid, packing, quality, simhash, token_count
from hourcast.llm.common import pick, table
from hourcast.session import ScratchScope, drop_scratch
from hourcast.sinks.util import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter go on, a null language filled with the predicted one; the others (``und``) are rejected."""
    docs = pick(docs, **{c: c for c in COLUMNS})
    net = langid.train(docs)
    found = langid.predict(docs.withColumn("whole", F.col("text")), net, carry=("whole", "lang", "source", "n_chars"))
    return found.where(F.col("lang_pred") != langid.UND).select(
        F.col("id").alias("doc_id"), F.col("c_whole").alias("text"), F.coalesce("c_lang", "lang_pred").alias("lang"),
        F.col("c_source").alias("source"), F.col("c_n_chars").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass go on with the lines that failed taken out; the others are rejected."""
    found = quality.cleaned(docs, carry=("lang", "source")).where("kept")
    return found.select(F.col("id").alias("doc_id"), F.col("clean_text").alias("text"), F.col("c_lang").alias("lang"),
                        F.col("c_source").alias("source"), F.length("clean_text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class goes on: the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item are rejected."""
    return decontaminate.without_leaks(pick(docs, **{c: c for c in COLUMNS}), table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences; lengths are word-piece counts."""
    counts = materialize(token_count.token_counts(docs).select("id", "n_tokens"), "lengths")
    return packing.pack(counts, "id", "n_tokens").withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: XXH64, the network and the tiling have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with ScratchScope(spark) as scratch:  # what the stage leaves goes once its result is written
            docs = scratch.hand_over(stage(spark, docs, sf_dir), name)
        if before:
            drop_scratch(spark, before)
        before = docs.scratch_path
    return docs
