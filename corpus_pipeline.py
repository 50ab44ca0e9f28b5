"""A training corpus from raw documents: reject, dedup, mix, tokenise.

Every stage takes (spark, docs, sf_dir) and its result is written and read again as the
next one's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, exact, mixing, neardup, quality
from quayside.llm.common import documents, prepare, scratch_dir, scratch_scope
from quayside.llm.registry import TOKENIZER, public_tokenizers


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    prepare(spark)
    return quality.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    prepare(spark)
    return neardup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources reach their target shares."""
    prepare(spark)
    return mixing.mix_sources(docs, mixing.MIX_WEIGHTS).select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text."""
    prepare(spark)
    return bpe.token_digests(docs, str(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("bpe", tokenise),
]

#: The classifier and the forest have no SQL form; a brute-force version tests them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with scratch_scope(spark):  # what the stage itself writes on the way
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
