"""A training corpus from raw documents: toxic documents go, repeated lines go, near duplicates go,
benchmark leaks go, and what is left is packed into sequences.

Every stage reads what the one before it wrote. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmill.llm import decontaminate, line_runs, near_dup, packing, toxicity
from rollmill.llm.base import fresh, prepare, table
from rollmill.llm.queries import BYTE_BPE, toxicity_model
from rollmill.session import scratch_path, stage

WORD = r"[^\x20\x09-\x0D]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or of sentence scores stays under one half."""
    prepare(spark)
    model = toxicity_model(spark, docs, sf_dir)
    scored, score, _ = toxicity.score_toxicity(docs, model, spans=False)
    return scored.where(F.col(score) < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 50 words or more; documents that lose every word go."""
    prepare(spark)
    done = line_runs.drop_later_copies(docs, min_words=50)
    removed = done.columns[-1]
    lost = (F.col(removed) > 0) & ~F.col("text").rlike(WORD)
    done = done.where(F.coalesce(~lost, F.lit(True))).drop(removed)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in done.columns else done


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; of rows that repeat doc_id and
    text one stays. Rows without doc_id all stay."""
    prepare(spark)
    found = near_dup.near_duplicates(docs)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    version, known = fresh(docs, "version"), docs.where("doc_id IS NOT NULL")
    left = known.join(gone, known["doc_id"] == gone["__gone"], "left_anti").withColumn(version, F.xxhash64("text"))
    return left.dropDuplicates(["doc_id", version]).drop(version).union(docs.where("doc_id IS NULL"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item's question and answer are found."""
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), capacity=1024, end_id=0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Classifiers, MinHash and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one starts."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), scratch_path(spark, f"corpus-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
