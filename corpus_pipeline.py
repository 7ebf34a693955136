"""From raw documents to token ids in five stages, each one an operator of ``strata.llm``.

A stage takes ``(spark, docs, sf_dir)``, works on all rows that the one before
kept, and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``. Staged tables of an earlier stage are deleted when the next
one begins (its result is written by then).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, lines, simhash, toxicity
from strata.llm.common import release
from strata.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine (trained on ``labels``) scores below one half."""
    release()
    model = toxicity.fit(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(spark, docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of repeated runs of two or more lines, and of single lines of 10 words or 100 bytes; ``n_chars`` follows the text."""
    release()
    out = lines.remove_repeats(spark, docs, min_lines=2, lone_words=lines.LONE_WORDS, lone_bytes=lines.LONE_BYTES)
    return _columns(out, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 2 bits), that of the smallest id."""
    release()
    return simhash.keep_one(spark, docs, shingle=3, radius=2)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that lie in 10-word windows of ``benchmark``; ``n_chars`` follows the text."""
    release()
    return _columns(decontaminate.remove_spans(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), and whether decoding gave the text back."""
    release()
    out = bpe.encode_decode(spark, docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


def _columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    cols = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*cols)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("byte_bpe", tokenize),
]

#: Trained scores, XXH64 fingerprints and token ids cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    release()
    return docs
