"""A training-data pipeline over ``documents``: quality rules, near-dedup,
benchmark decontamination, source mixing, token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read back as the next stage's ``docs``; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedline.llm import decontaminate, mixing, near_dedup, quality, token_files
from feedline.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_representatives(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, max_epochs=2)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("quality rules", quality_rules), ("near dedup", near_duplicates), ("decontamination", decontamination),
          ("source mixing", source_mixing), ("token output", token_output)]

#: The stages use a tokenizer, sketches and seeded hashes: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
