"""From raw documents to token counts of a training mix, in five stages.

Each stage takes the documents that the one before it kept and returns those that it keeps, in the columns of
documents; the last returns what it made of each.  Between stages the documents are written as Parquet to the shared folder,
and deleted there when the next stage has written its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnlake.llm import bradley_terry, chosen_path, mixing, sentence_piece, stream_dedup
from cairnlake.llm.queries import documents, labels, piece_model
from cairnlake.llm.scratch import discard, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the ranking learned from the labels rejects."""
    allowed = ~bradley_terry.held_out(F.col("doc_id"), 3, 1)
    return bradley_terry.keep_good(docs, bradley_terry.learn(docs, labels(spark, sf_dir), allowed, seed=1))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that differ in blanks only, keep the longest."""
    return stream_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates on five-word shingles, similarity 0.8, keep the one with the smallest doc_id."""
    return chosen_path.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take sources by their target weights, repeating or leaving out blocks of documents."""
    return mixing.taken_texts(docs, seed=6)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text into ids and decode them again."""
    return sentence_piece.token_digests(docs, piece_model())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: SQL can express neither the learned ranking nor the encoding; tests/llm/test_pieces.py checks properties of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
