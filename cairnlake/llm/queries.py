"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm import (
    bradley_terry, chat_format, chosen_path, conversation_repair, filter_audit, i_match, kneser_ney, mixing, oracle, prefix_join,
    seed_extend, sentence_piece, sharding, stream_dedup,
)

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def piece_model() -> str:
    """The vocabulary file the registered query uses; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_bradley_terry(spark: SparkSession, folder: str) -> DataFrame:
    return bradley_terry.rank_documents(documents(spark, folder), labels(spark, folder), parts=3, part=1, seed=1)


def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.score_documents(documents(spark, folder), labels(spark, folder), parts=5, part=0)


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    return chat_format.format_conversations(conversations.unionByName(more))


def op4_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.link_documents(documents(spark, folder), threshold=Fraction(85, 100), width=5)


def op5_seed_extend(spark: SparkSession, folder: str) -> DataFrame:
    return seed_extend.remove_repeats(documents(spark, folder), window=35, anchor=8, digest=True)


def op6_sainte_lague(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, folder), weights=(1, 2, 3), max_repeats=3, shards=8, seed=6)


def op7_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return stream_dedup.deduplicate(documents(spark, folder))


def op8_sentence_piece(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_piece.token_digests(documents(spark, folder), piece_model())


def op9_i_match(spark: SparkSession, folder: str) -> DataFrame:
    return i_match.fingerprint_documents(documents(spark, folder))


def op10_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, folder), shards=40, seed=10)


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(documents(spark, folder), labels(spark, folder))


def op12_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return prefix_join.find_contamination(documents(spark, folder), benchmark, window=10)


def op13_checkpoint_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair_conversations(spark.read.parquet(f"{folder}/conversations.parquet"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # stands at the top of the repository and uses this module

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Query]:
    found = {name: query for name, query in globals().items() if name.startswith("op") and callable(query)}
    return found | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
