"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm import (byte_bpe, hard_negatives, minhash, mixing, ngram_join, pii, prefix_trie, quality_model, quality_rules, sql, substring_dedup,
                         token_store, topk, url_filter)
from rookery.llm.cluster import table, word_count
from rookery.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op1_url_filter": sql.URL_FILTER,
    "op2_topk": sql.TOPK,
    "op4_ngram_join": sql.NGRAM_JOIN,
    "op6_substring_dedup": sql.SUBSTRING_DEDUP,
    "op8_quality_rules": sql.QUALITY_RULES,
    "op11_prefix_trie": sql.PREFIX_TRIE,
    "op12_minhash": sql.MINHASH,
    "op13_hard_negatives": sql.HARD_NEGATIVES,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules)


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


PII_KEY = "rookery-surrogates-1"  # a deployment passes its own secret


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_entities")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), fold != 1)
    scored = quality_model.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (quality_rules.quality_rules(docs, keep=["doc_id"])
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = cut_lineage(table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")))
    mixed = mixing.mix_sources(sized)
    return mixed.select("doc_id", "size", "source_size", "target",
                        F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"]).alias("taken"),
                        F.array_join(F.transform("draws", lambda d: d["shard"].cast("string")), ",").alias("shards"))


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_store.scratch(spark, "tokens")
    token_store.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), path, end_id=2)
    return token_store.describe_tokens(spark, path)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.conversation_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.share_heads(turns, 20, lambda c: F.crc32(c.cast("string").cast("binary")) % 4, most=4))


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), n=5, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)
