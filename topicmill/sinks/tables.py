"""Result tables in parquet. Every write replaces what was there."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topicmill.operators.lda import TopicModel


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write and read back, so that later steps start from the written rows."""
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_topic_model(model: TopicModel, path: str) -> None:
    """The topics' weights for each word, ``(token_id, vector)``, for any topic count."""
    write_table(model.terms, path)
