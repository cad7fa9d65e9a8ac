"""Pipeline over ``documents``: each stage calls one operator of ``tierlake.llm``.

A stage takes (spark, docs, sf_dir) and works on every row its predecessor kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import bagminhash, bpe, mixing, pii, quality
from tierlake.llm.common import table
from tierlake.session import run_dir


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of the smallest doc_id."""
    return bagminhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; n_chars follows the new text."""
    return pii.mask(docs, pii.learn(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by their raked factors; those of rare cells may come several times."""
    return mixing.drawn(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the ids of each whole text, digested, and the proof of decoding."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]

#: The quality, near-duplicate, personal-data and encoding stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole table, each written and read again."""
    docs, folder = table(spark, sf_dir, "documents"), run_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
