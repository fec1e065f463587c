"""Text exports. Each is a folder of part files that read in name order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicmill.functions import text as X
from topicmill.operators.numbering import number_by


def _write_ordered(lines: DataFrame, path: str, *order: str) -> None:
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def topic_lines(topic_terms: DataFrame) -> DataFrame:
    """``(topic_id, rank, line)``: a heading per topic, then its words."""
    words = topic_terms.select(
        "topic_id", "rank", X.topic_line(F.col("token"), F.col("weight")).alias("line")
    )
    headings = topic_terms.select("topic_id").distinct().select(
        "topic_id", F.lit(0).alias("rank"), X.topic_heading(F.col("topic_id")).alias("line")
    )
    return headings.unionByName(words)


def document_topic_lines(doc_topics: DataFrame, index: DataFrame) -> DataFrame:
    """``(doc_no, weight, topic_id, line)``: a heading per document, then its
    topics by ascending weight."""
    numbered = doc_topics.join(index.select("doc_id", "doc_no"), "doc_id")
    topics = numbered.select(
        "doc_no",
        "weight",
        "topic_id",
        X.document_topic_line(F.col("weight"), F.col("topic_id")).alias("line"),
    )
    headings = index.select(
        "doc_no",
        F.lit(-1.0).alias("weight"),
        F.lit(-1).alias("topic_id"),
        X.document_heading(F.col("doc_no")).alias("line"),
    )
    return headings.unionByName(topics)


def number_documents(index: DataFrame) -> DataFrame:
    """Add ``doc_no``, the rank of ``doc_id`` from 0."""
    return number_by(index, "doc_id", "doc_no")


def write_topics(topic_terms: DataFrame, path: str) -> None:
    _write_ordered(topic_lines(topic_terms), path, "topic_id", "rank")


def write_document_topics(doc_topics: DataFrame, index: DataFrame, path: str) -> None:
    lines = document_topic_lines(doc_topics, index)
    _write_ordered(lines, path, "doc_no", "weight", "topic_id")


def document_path_lines(index: DataFrame) -> DataFrame:
    """``(doc_no, line)`` of every document."""
    return index.select(
        "doc_no", X.document_path_line(F.col("doc_no"), F.col("doc_id")).alias("line")
    )


def write_document_paths(index: DataFrame, path: str) -> None:
    _write_ordered(document_path_lines(index), path, "doc_no")


def matrix_market_lines(
    entries: DataFrame, index: DataFrame, columns: int, value: str
) -> DataFrame:
    """``(row, column, line)`` of a coordinate matrix, counted from 1, with the
    banner and size first. Documents without entries count as rows."""
    kind = "integer" if value == "tf" else "real"
    numbered = entries.join(index.select("doc_id", "doc_no"), "doc_id")
    body = numbered.select(
        (F.col("doc_no") + 1).alias("row"),
        (F.col("token_id") + 1).cast("bigint").alias("column"),
        F.col(value).cast("string").alias("value"),
    )
    lines = body.select("row", "column", F.concat_ws(" ", "row", "column", "value").alias("line"))
    size = entries.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).cast("bigint").alias("row"),
        F.lit(1).cast("bigint").alias("column"),
        F.concat_ws(" ", F.lit(index.count()), F.lit(columns), "n").alias("line"),
    )
    banner = size.select(
        "row",
        F.lit(0).cast("bigint").alias("column"),
        F.lit(f"%%MatrixMarket matrix coordinate {kind} general").alias("line"),
    )
    return lines.unionByName(size).unionByName(banner)


def write_matrix_market(
    entries: DataFrame, index: DataFrame, columns: int, value: str, path: str
) -> None:
    _write_ordered(matrix_market_lines(entries, index, columns, value), path, "row", "column")
