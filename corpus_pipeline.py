"""A corpus made ready for training: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept. ``run`` writes what a stage returns to the shared folder and
reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewright.llm import decontaminate, exact_dedup, ngram_join, piece_bpe, toxicity
from lanewright.llm.common import stage, table
from lanewright.llm.queries import PIECE_MODEL


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest doc_id stays."""
    return ngram_join.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, as digests, with those of the decoded text."""
    return piece_bpe.piece_digest(docs, model_path=PIECE_MODEL)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

# Learned scores, tiling and tokenisation have no SQL form; tests check the operators, not this query.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = work.cut(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
