"""Corpus pipeline: from raw documents to token ids, one training-data operator per stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor kept; its decisions take
effect in the rows and texts that it returns.  All but the last return the columns of ``documents``.  ``run`` writes every
stage as Parquet below the shared scratch folder and reads it again, so a lost executor repeats
one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables.llm import decontaminate, line_runs, pieces, quality_rules, simhash
from perishables.llm.common import store, table

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # a public vocabulary, read where it is


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or lie far from their group's centre go."""
    return quality_rules.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of line runs of six words or more go, and documents that are nothing else."""
    return line_runs.without_copies(docs, min_words=6)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each component stays."""
    return simhash.keep_one(docs, size=3, limit=2)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: spans that hold ten words of an item go, and documents that are mostly such spans."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, max_coverage=0.5)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: the documents with ``ids``, ``n_ids`` and whether the ids decode to the text."""
    coded = pieces.decode(pieces.encode(docs, PIECE_MODEL, ids_col="ids"), PIECE_MODEL, ids_col="ids", text_col="decoded")
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_ids", "round_trip", "decoded")]
    return coded.select(*(F.col(f"`{c}`") for c in kept), "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_ids"),
                        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("quality_rules", keep_good_documents),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", remove_benchmark),
    ("sentencepiece", encode_pieces),
]

#: SQL expresses neither the fingerprints' components nor the best paths of pieces; the tests hold the stages
#: against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
