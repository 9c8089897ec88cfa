"""A corpus pipeline: quality rules, near duplicates, PII, source mix, tokens.

``STAGES`` are applied in order; each result is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns
of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm import byte_bpe, mixing, ngram_join, pii, quality_rules
from rookery.llm.cluster import table, word_count
from rookery.llm.queries import PII_KEY
from rookery.session import cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text has no words and
    goes; repeated rows are judged alike, each by itself."""
    return quality_rules.quality_rules(docs).where("kept").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates
    (five-word shingles, Jaccard 0.8 or more). Of rows that repeat id and text the
    least stays, by their other columns; those without words are in no group, and
    rows without an id stay if their group has no id at all."""
    found = ngram_join.jaccard_components(docs, n=5, percent=80)
    others = found.where("NOT (doc_id <=> component_id)").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    rows = docs.withColumn("__text", F.xxhash64("text"))
    left = rows.join(others, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_anti")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = left.groupBy("doc_id", "__text").agg(F.min(F.struct(*rest, "text")).alias("__row")) if rest else left.dropDuplicates(["doc_id", "__text"])
    return least.select("doc_id", "__row.*").select(*docs.columns) if rest else least.select(*docs.columns)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text.
    A null or empty text stays as it is; repeated rows get the same surrogates."""
    replaced = pii.replace_pii(docs, PII_KEY, count_col="__entities")
    chars = F.when(F.col("__entities") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", chars).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, laid out as the splitting
    tree deals them: by output shard, and in the shard's shuffled order. The draw
    that the quota cuts counts if it has half of the document. Documents without
    words (null, empty) are never taken; repeated rows are documents of their own."""
    rows = mixing.mix_sources(docs.withColumn("__doc_words", word_count(F.col("text"))), size_col="__doc_words")
    whole = rows.withColumn("draws", F.filter("draws", lambda d: 2 * d["words"] >= F.col("__doc_words")))
    return mixing.mixture(whole).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each row's text, and a digest of what they decode to. A null text
    counts as empty, and an empty one has no ids; repeated rows are coded alike."""
    coded = byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"),
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                keep=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", keep_good), ("ngram_join", one_of_each_group), ("pii", without_pii),
          ("mixing", mixed), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs


ORACLE_SQL = None  # shingle groups, keyed surrogates and byte merges are not expressible
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
