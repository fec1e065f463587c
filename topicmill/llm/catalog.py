"""The registered queries of the operators in this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.llm import alignment, best_fit, byte_bpe, conversation_repair, lengths, packing, pivot_search, projected_search, simhash, substring_dedup, suffix_dedup, toxicity, url_filter
from topicmill.llm.common import table

WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_multi_50k.tiktoken"
ENGLISH_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def op1_topk_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_products(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), step=20, k=20)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents", "doc_id", "text"), length=100)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(WORD_FILE)).drop("piece_ids")


def op4_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), step=50, k=5)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=4, bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.round_trip(docs, public_tokenizers.path(BYTE_FILE), public_tokenizers.PATTERN)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    score = F.col("toxicity_score")
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents", "doc_id", "text"), window=35)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lengths.context_limits(lengths.encoded_lengths(docs, public_tokenizers.path(WORD_FILE)))


#: Rules of the URL query: verdict, host and path.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES).drop("score")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return best_fit.pack(docs, public_tokenizers.path(ENGLISH_FILE), public_tokenizers.PATTERN).drop("piece_ids")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path
    return alignment.digests(docs, path(ENGLISH_FILE), public_tokenizers.PATTERN, path(PIECE_FILE))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation_repair.audits(conversation_repair.damaged(conversations), ids=conversations)


QUERIES = {
    "op1_topk_products": op1_topk_products,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_projected_neighbours": op4_projected_neighbours,
    "op5_simhash": op5_simhash,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_url_filter": op10_url_filter,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {}
