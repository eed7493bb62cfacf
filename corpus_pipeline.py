"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes what its predecessor kept and returns documents, the last one the pieces of sequences. `run` writes
each stage's result as Parquet in the shared folder and reads it back for the next, so that a stage is computed once
and a lost executor costs at most the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from millrace.llm.base import given, ready
from millrace.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Nine tenths of the tokens, and no source more than once: the largest source gives way, small ones stay whole.
MIXTURE = mixing.Target(0.9, max_repeats=1.0)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior holds for good and that pass the base limits."""
    judged = quality_rules.quality_rules(_documents(docs))
    return judged.filter(F.col("kept")).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(_documents(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.near_dedup(_documents(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the mixture."""
    return mixing.mix_rows(_documents(docs), MIXTURE)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(_documents(docs))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
# Similarity groups and packing are beyond SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    ready(spark)
    docs = given(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


pipeline = run
