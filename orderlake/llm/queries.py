"""The registered corpus queries: each applies its operator, with production parameters,
to its whole table and derives the contract's columns from the operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.bpe import encode_documents
from orderlake.llm.chat import format_conversations, read_conversations
from orderlake.llm.common import documents
from orderlake.llm.imatch import fingerprints
from orderlake.llm.mixing import mix_counts
from orderlake.llm.near_dup import near_duplicates
from orderlake.llm.pii import pii_digest
from orderlake.llm.quality_rules import quality_rules
from orderlake.llm.repair import repair_conversations
from orderlake.llm.secrets import scan_documents
from orderlake.llm.sharding import shard_documents
from orderlake.llm.suffix_dedup import dedup_substrings
from orderlake.llm.toxicity import score_toxicity
from orderlake.llm.variants import spelling_variants


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(documents(spark, sf_dir))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=2, percent=80)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), n_shards=40)


def vocabulary_path() -> str:
    """The public byte-level vocabulary; pass another path to encode_documents for your own."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), vocabulary_path(), verify=True)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")
    return read_conversations(format_conversations(turns.unionByName(more)))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir)).drop("kept")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(documents(spark, sf_dir))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality_rules(documents(spark, sf_dir))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "n_cut_words"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix_counts(documents(spark, sf_dir))
            .select("doc_id", "size", "source_size", "target", "taken"))


def damaged(turns: DataFrame) -> DataFrame:
    """The faults the contract plants, by crc32 of conv_id:turn (nulls are one space);
    copies counts a row, 0 for a dropped one and 2 for a repeated one."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return turns.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(space("role")).alias("role"),
                        text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    return score_toxicity(documents(spark, sf_dir), labels)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_near_dup": op2_near_dup,
        "op3_sharding": op3_sharding,
        "op4_bpe": op4_bpe,
        "op5_chat": op5_chat,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_secrets": op7_secrets,
        "op8_imatch": op8_imatch,
        "op9_quality_rules": op9_quality_rules,
        "op10_mixing": op10_mixing,
        "op11_repair": op11_repair,
        "op12_variants": op12_variants,
        "op13_toxicity": op13_toxicity,
    }
