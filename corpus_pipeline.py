"""Cleaning of a training corpus: quality, near duplicates, repeated passages, benchmark leaks, then tokens.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and returns the columns of `documents`; the last returns one row of
token counts and digests per document. `run` writes every stage as Parquet in the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlab.llm.bpe import encode_documents, token_digests
from martlab.llm.common import Scratch
from martlab.llm.decontaminate import remove_contaminated
from martlab.llm.near_dedup import keep_one_each
from martlab.llm.paragraphs import remove_repeats
from martlab.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_each(spark, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(encode_documents(
        spark, docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", tokens),
]

# Language models, signatures and token merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
