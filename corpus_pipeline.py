"""From raw documents to packed token sequences: quality rules, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm import decontam, linededup, neardup, packing, quality, shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that match an earlier line; a document with no word left goes."""
    cleaned = linededup.dedup(docs, drop_emptied=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: shingles of five words, similarity of 0.8 or more."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Token packing isn't expressible in SQL; tests compare run() with a plain-Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from `documents`. What a stage returns is written to the shared folder before the next one reads it; a stage's own tables go when its result stands, and
    its result goes when the next one's does. The last stage reads the one before it lazily, so that one stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with shared.scratch(spark) as results:
            with shared.scratch(spark):
                docs = shared.written(stage(spark, docs, sf_dir), name, outlive=True)
            result, results[:] = list(results), []  # what stands now outlives the scope
        for path in before:
            shared.deleted(spark, path)
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
