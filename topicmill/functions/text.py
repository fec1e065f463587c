"""Text expressions: tokens, term counts and report lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed value: a token is a run of at least two ASCII letters in lower-cased text.
TOKEN_PATTERN = "[a-z][a-z]+"


def tokens(text: Column) -> Column:
    """Array of tokens in text order; a null text has none."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(TOKEN_PATTERN), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    Columns of two selects are put together by the optimizer, which then computes
    the inner one again for each element of a lambda that uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_starts(ordered: Column) -> Column:
    """Positions at which a new value begins in a sorted array."""
    positions = F.when(
        F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)
    ).otherwise(F.array().cast("array<int>"))
    return F.filter(
        positions,
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def run_lengths(ordered: Column, starts: Column) -> Column:
    """``array<struct<token, tf>>`` of a sorted array and its run starts."""
    return F.transform(
        starts,
        lambda start, i: F.struct(
            F.get(ordered, start).alias("token"),
            (F.coalesce(F.get(starts, i + 1), F.size(ordered)) - start)
            .cast("bigint")
            .alias("tf"),
        ),
    )


def topic_heading(topic_id: Column) -> Column:
    return F.format_string("Topic #%d", topic_id)


def topic_line(token: Column, weight: Column) -> Column:
    return F.concat(F.lit("\t"), token, F.lit("\t"), weight.cast("string"))


def document_heading(doc_no: Column) -> Column:
    return F.format_string("Doc #%d", doc_no)


def document_topic_line(weight: Column, topic_id: Column) -> Column:
    return F.concat(
        F.lit("\t"), weight.cast("string"), F.lit(" on topic #"), topic_id.cast("string")
    )


def document_path_line(doc_no: Column, doc_id: Column) -> Column:
    return F.concat(document_heading(doc_no), F.lit("\t"), doc_id.cast("string"))
