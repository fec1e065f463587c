"""Look-ups between a bag of words and a dictionary.

A dictionary of checked size is broadcast; beyond it only its frequent words are,
and the others meet by a shuffle (``lookup``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from topicmill.functions import defaults
from topicmill.operators.lookup import join_words


def lookup_ids(bow: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(doc_id, token, token_id, tf)``; words not in the dictionary get -1."""
    ids = dictionary.select("token", "token_id")
    return join_words(bow, ids, "token", "left").select(
        "doc_id",
        "token",
        F.coalesce("token_id", F.lit(defaults.UNKNOWN_TOKEN_ID)).alias("token_id"),
        "tf",
    )


def doc2idx(bow: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(doc_id, token_id, tf)`` with all unknown words of a document as -1."""
    found = lookup_ids(bow, dictionary)
    return found.groupBy("doc_id", "token_id").agg(F.sum("tf").alias("tf"))


def doc2bow(bow: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(doc_id, token_id, tf)`` of the known words only."""
    ids = dictionary.select("token", "token_id")
    return join_words(bow, ids, "token").select("doc_id", "token_id", "tf")


def union_corpora(parts: dict[str, DataFrame]) -> DataFrame:
    """One corpus from several; the name of each part keeps ids apart."""
    named = [part.withColumn("corpus", F.lit(name)) for name, part in parts.items()]
    return reduce(DataFrame.unionByName, named)
