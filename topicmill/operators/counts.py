"""Tokens, bags of words and corpus counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicmill.functions import text as X


def tokenize(docs: DataFrame) -> DataFrame:
    """``(doc_id, tokens)``, one row per document, also for empty ones."""
    return docs.select("doc_id", X.tokens(F.col("text")).alias("tokens"))


def doc_tokens(docs: DataFrame) -> DataFrame:
    """``(doc_id, token)``, one row per occurrence."""
    return tokenize(docs).select("doc_id", F.explode("tokens").alias("token"))


def bags(docs: DataFrame) -> DataFrame:
    """``(doc_id, words)`` with ``array<struct<token, tf>>`` in token order, one row per
    document, also for empty ones."""
    words = X.let(
        F.sort_array(X.tokens(F.col("text"))),
        lambda ordered: X.let(X.run_starts(ordered), lambda starts: X.run_lengths(ordered, starts)),
    )
    return docs.select("doc_id", words.alias("words"))


def bag_of_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, token, tf)`` of a corpus with one row per document.

    A document's words are all in its row, so they are counted there: sort the
    tokens, take the run lengths. The corpus is not shuffled.
    """
    ordered = docs.select("doc_id", F.sort_array(X.tokens(F.col("text"))).alias("ordered"))
    starts = ordered.withColumn("starts", X.run_starts(F.col("ordered")))
    counts = X.run_lengths(F.col("ordered"), F.col("starts"))
    return starts.select("doc_id", F.inline(counts))


def from_bags(found: DataFrame) -> DataFrame:
    """``(doc_id, token, tf)`` of ``bags``."""
    return found.select("doc_id", F.inline("words"))


def bag_of_words_from_lines(lines: DataFrame) -> DataFrame:
    """``(doc_id, token, tf)`` of a corpus with one row per line.

    A document may span many splits. Counts are combined in each task before
    the shuffle on ``(doc_id, token)``, so a large document is spread as well.
    """
    return doc_tokens(lines).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(bow: DataFrame) -> DataFrame:
    return bow.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def collection_frequency(bow: DataFrame) -> DataFrame:
    return bow.groupBy("token").agg(F.sum("tf").alias("cf"))


def term_statistics(bow: DataFrame) -> DataFrame:
    """``(token, df, cf)`` in one pass."""
    return bow.groupBy("token").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )


def corpus_stats(docs: DataFrame) -> DataFrame:
    """One row ``(num_docs, num_pos, num_nnz)`` of a corpus with one row per document."""
    sizes = tokenize(docs).select(
        F.size("tokens").cast("bigint").alias("pos"),
        F.size(F.array_distinct("tokens")).cast("bigint").alias("nnz"),
    )
    return sizes.agg(
        F.count(F.lit(1)).alias("num_docs"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("num_pos"),
        F.coalesce(F.sum("nnz"), F.lit(0)).alias("num_nnz"),
    )


def stats_from_terms(terms: DataFrame, num_docs: int) -> DataFrame:
    """The same row from ``(token, df, cf)``; documents are counted apart, since
    an empty one has no terms."""
    return terms.agg(
        F.lit(num_docs).cast("bigint").alias("num_docs"),
        F.coalesce(F.sum("cf"), F.lit(0)).alias("num_pos"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("num_nnz"),
    )


def unknown_counts(bow: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(doc_id, unknown_tf)`` of the words the dictionary lacks."""
    missing = bow.join(dictionary.select("token"), "token", "left_anti")
    return missing.groupBy("doc_id").agg(F.sum("tf").alias("unknown_tf"))
