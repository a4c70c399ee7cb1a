"""The corpus pipeline: five stages over ``documents``, each one of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
``documents``:

1. quality_rules   rejected documents go, and frequent lines are removed from the others
2. near_dedup      one document of each group of near copies stays (5 words, 0.8)
3. pii             personal data is replaced by its kind
4. mixing          documents are repeated or left out to meet the sources' targets
5. bpe             token counts and digests of ids and of the decoded text, per document

Defined results on odd input are those of the operators; an empty table passes through
every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm.bpe import encode_documents
from orderlake.llm.common import documents, written
from orderlake.llm.mixing import mix_documents
from orderlake.llm.near_dup import drop_near_duplicates
from orderlake.llm.pii import redact
from orderlake.llm.quality_rules import filter_documents
from orderlake.llm.queries import vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, k=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, vocabulary_path(), verify=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing), ("bpe", bpe)]

# Sketches, token ids and seeded hashes have no counterpart in SQL; tests/llm holds the
# pipeline against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
