"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, counts, decontaminate, lines, rank, sharding, simhash, stripes, substring, suffixes, topk, toxicity, warc
from strata.session import scratch_path

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(spark, table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "source")
    out = sharding.interleave(spark, rows, 8, key_cols=("doc_id", "text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.remove_repeats(spark, docs, min_lines=2)
    return out.select("doc_id", F.col("n_lines_").alias("n_lines"), F.col("n_removed_").alias("n_removed"),
                      F.size("run_lines_").cast("long").alias("n_runs"),
                      F.coalesce(F.array_max("run_lines_"), F.lit(0)).cast("long").alias("longest_run"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return out.select("page_id", "type", "record_id", "refers_to", "linked_to", "target_uri", "date", "block_digest",
                      F.octet_length("block").cast("long").alias("n_bytes"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_spans(spark, docs, table(spark, sf_dir, "benchmark"), size=10)
    hit = F.aggregate(F.zip_with("span_start_", "span_end_", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("doc_id", F.col("n_words_").alias("n_words"), hit.alias("n_hit"), F.size("items_").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items_", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(spark, docs, model)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(spark, table(spark, sf_dir, "documents"), window=100)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("span_start").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256).select("query_id", "rank", "vec_id", "score")


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripes.audit(spark, table(spark, sf_dir, "documents"), min_docs=3, terms=200)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own that starts empty; see ``counts.token_counts`` for one that lasts."""
    out = counts.token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), scratch_path(spark, "token-cache"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_sharding, op3_byte_bpe, op4_line_dedup, op5_warc_derivatives, op6_simhash,
                                    op7_decontamination, op8_toxicity, op9_suffix_dedup, op10_exact_topk,
                                    op11_divergence_audit, op12_ranked_search, op13_token_counts)}
