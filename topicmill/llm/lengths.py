"""Exact histogram of encoded lengths and what it says about every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicmill.llm.common import named, texts, written
from topicmill.llm.word_tokens import texts_of, word_tokenizer

#: Lengths that one block of the suffix sums covers.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``tokens``: the number of ids of each whole text; null or empty: 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = word_tokenizer(tokenizer_path)
        for batch in batches:
            counts = []
            for at in range(0, len(batch), 256):
                counts += [len(ids) // 4 for ids in tokenizer.encode_all(texts_of(batch["text"].iloc[at : at + 256]))]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": counts})

    return named(texts(docs).mapInPandas(run, "doc_id long, tokens long"))


def histogram(lengths: DataFrame) -> DataFrame:
    """``tokens``, ``docs``: how many documents have each length."""
    return lengths.groupBy("tokens").agg(F.count("*").alias("docs"))


def context_limits(lengths: DataFrame) -> DataFrame:
    """One row for every length that occurs, as a context limit.

    ``docs``: documents of that length; ``docs_within``: documents not longer;
    ``tokens_within``: their tokens; ``docs_over`` and ``tokens_over``: the longer ones
    (suffix sums); ``truncated_tokens``: tokens left when every document is cut at
    the limit; ``quantile``: share of documents not longer, so the p-quantile is the
    least limit with ``quantile >= p``. Between two rows every figure follows from the
    lower one, so all limits are answered. An empty table gives no rows.

    Suffix sums are taken inside blocks of ``BLOCK`` lengths, then over block totals,
    whose number only grows with the longest document.
    """
    counts = written(histogram(lengths).withColumn("block", F.floor(F.col("tokens") / BLOCK)), "lengths")
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("tokens")).alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
    )
    whole = blocks.agg(F.sum("d").alias("all_docs"), F.sum("t").alias("all_tokens"))
    above = Window.partitionBy("block").orderBy(F.desc("tokens")).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.col("docs") * F.col("tokens")
    over = (
        counts.withColumn("d_above", F.coalesce(F.sum("docs").over(above), F.lit(0)))
        .withColumn("t_above", F.coalesce(F.sum(weight).over(above), F.lit(0)))
        .join(F.broadcast(totals), "block")
        .crossJoin(F.broadcast(whole))  # one row
        .withColumn("docs_over", F.col("d_above") + F.col("d_later"))
        .withColumn("tokens_over", F.col("t_above") + F.col("t_later"))
    )
    within, inside = F.col("all_docs") - F.col("docs_over"), F.col("all_tokens") - F.col("tokens_over")
    return over.select(
        F.col("tokens").alias("context_limit"),
        "docs",
        within.alias("docs_within"),
        inside.alias("tokens_within"),
        "docs_over",
        "tokens_over",
        (inside + F.col("docs_over") * F.col("tokens")).alias("truncated_tokens"),
        (within / F.col("all_docs")).alias("quantile"),
    )
