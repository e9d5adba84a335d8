"""The corpus pipeline: filter, clean, dedupe, decontaminate and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of their documents.  Empty tables pass every stage; null
and empty texts are defined by the operator that a stage calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlens.llm import decontam, langid, lines, packing, simhash
from govlens.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those that every learned language finds odd beyond its calibrated limit.

    The models learn from the documents with a language whose crc32 of the id
    is not 1 modulo 3.  If there are none to learn from, every document with
    a letter stays, as nothing is known against it.
    """
    model = langid.learn(docs.where(~langid.held_out()))
    out = langid.identify(docs, model, taught=~langid.held_out())
    gone = F.col("_rejected") if model.langs else ~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return out.where(~gone).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go from all of them; n_chars is counted again. No document goes."""
    out = lines.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of three-word shingles at three bits or fewer, the one of least id stays."""
    return simhash.keep_one(docs, simhash.simhash_groups(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, within a tenth of its length in edits, go."""
    out = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.where(F.size("_hits") == 0).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 4,096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither language models nor packing; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
