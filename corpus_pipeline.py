"""Cleaning of a training corpus in five stages over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callweave.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from callweave.llm.text import documents
from callweave.session import materialise, release
from callweave.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that fail them."""
    return quality.apply_rules(docs).where("kept").withColumns({
        "text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long"),
    }).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; a document of which every line
    repeats goes."""
    left = line_dedup.dedup_lines(docs)
    return left.where("n_lines = 0 OR n_removed < n_lines").withColumn(
        "n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies (five-word shingles,
    similarity 0.8 or more)."""
    gone = near_dedup.near_duplicates(docs).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = read_table(spark, "benchmark", root=sf_dir)
    return decontaminate.find_leaks(docs, items).where("size(leaks) = 0").select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the number and a digest of its token ids, and whether they decode
    to its text."""
    coded = bpe.encode(docs, bpe.tokenizer_file())
    return coded.select(
        *docs.columns, "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("bpe", token_stage),
]

#: Two of the stages cannot be written in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again; a
    stage's table goes when the next one is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        done = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        release(docs)
        docs = done
    return docs
