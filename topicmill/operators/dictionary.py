"""Build, filter and merge dictionaries ``(token, token_id, df, cf)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicmill.functions import defaults
from topicmill.operators.counts import term_statistics
from topicmill.operators.numbering import number_by


def build_dictionary(bow: DataFrame) -> DataFrame:
    """Dictionary of a bag of words; ids follow token order."""
    return number_by(term_statistics(bow), "token", "token_id").select(
        "token", "token_id", "df", "cf"
    )


def renumber(terms: DataFrame) -> DataFrame:
    """Close the gaps a filter leaves in the ids, keeping their order."""
    return number_by(terms.select("token", "df", "cf"), "token", "token_id").select(
        "token", "token_id", "df", "cf"
    )


def keep_ids(terms: DataFrame, earlier: DataFrame) -> DataFrame:
    """``terms`` with the ids of an earlier dictionary; words that it lacks get the next free
    ids in token order. Ids of words that are gone stay unused."""
    known = terms.select("token", "df", "cf").join(earlier.select("token", "token_id"), "token", "left")
    fresh = number_by(
        known.filter(F.col("token_id").isNull()).drop("token_id"), "token", "token_id", first=id_space(earlier)
    )
    found = known.filter(F.col("token_id").isNotNull()).unionByName(fresh)
    return found.select("token", "token_id", "df", "cf")


def id_space(terms: DataFrame) -> int:
    """One more than the largest id."""
    last = terms.agg(F.max("token_id")).first()[0]
    return 0 if last is None else last + 1


def upper_limit(no_above: float, num_docs: int) -> int:
    return int(no_above * num_docs)


def filter_extremes(
    terms: DataFrame,
    num_docs: int,
    no_below: int = defaults.NO_BELOW,
    no_above: float = defaults.NO_ABOVE,
    keep: DataFrame | None = None,
) -> DataFrame:
    """Keep terms with ``no_below <= df <= no_above * num_docs``, and kept words."""
    in_range = F.col("df").between(no_below, upper_limit(no_above, num_docs))
    if keep is None:
        return terms.filter(in_range)
    marked = keep.select(F.col("word").alias("token"), F.lit(True).alias("_kept")).distinct()
    return (
        terms.join(marked, "token", "left")
        .filter(in_range | F.col("_kept"))
        .drop("_kept")
    )


def remove_stopwords(terms: DataFrame, stop: DataFrame) -> DataFrame:
    lowered = stop.select(F.lower("word").alias("token"))
    return terms.join(lowered, "token", "left_anti")


def filter_dictionary(
    terms: DataFrame,
    num_docs: int,
    no_below: int = defaults.NO_BELOW,
    no_above: float = defaults.NO_ABOVE,
    stop: DataFrame | None = None,
    keep: DataFrame | None = None,
) -> DataFrame:
    """Frequency limits with keep-words exempt, then stop-words: a word on both
    lists goes."""
    kept = filter_extremes(terms, num_docs, no_below, no_above, keep)
    return kept if stop is None else remove_stopwords(kept, stop)


def merge_dictionaries(base: DataFrame, other: DataFrame) -> DataFrame:
    """Add the counts of ``other`` to ``base``; known ids stay, new words get
    the next free ids in token order."""
    counts = (
        base.select("token", "token_id", "df", "cf")
        .unionByName(other.select("token", F.lit(None).cast("bigint").alias("token_id"), "df", "cf"))
        .groupBy("token")
        .agg(F.max("token_id").alias("token_id"), F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    )
    fresh = number_by(
        counts.filter(F.col("token_id").isNull()).drop("token_id"),
        "token",
        "token_id",
        first=id_space(base),
    )
    return counts.filter(F.col("token_id").isNotNull()).unionByName(fresh)


def merge_stats(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sum two ``(num_docs, num_pos, num_nnz)`` rows."""
    both = left.unionByName(right)
    return both.agg(*[F.sum(c).alias(c) for c in ("num_docs", "num_pos", "num_nnz")])
