"""Reload what an earlier run wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicmill.operators.tfidf import VectorTable


def saved_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A finished table, or None: a write that did not finish leaves no
    ``_SUCCESS`` file and is not used."""
    return spark.read.parquet(path) if _exists(spark, f"{path}/_SUCCESS") else None


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def saved_vectors(spark: SparkSession, path: str, size: int) -> VectorTable | None:
    return None if saved_table(spark, path) is None else VectorTable(spark, path, size)


def saved_topics(spark: SparkSession, folder: str, counts: list[int]) -> dict[int, DataFrame] | None:
    """The written models of these topic counts, or None unless all are finished."""
    found = {k: saved_table(spark, f"{folder}/lda_model/k={k}") for k in counts}
    return None if any(terms is None for terms in found.values()) else found


def saved_topic_counts(spark: SparkSession, folder: str) -> list[int]:
    """The topic counts that have a folder below ``folder/lda_model``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lda_model")
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [entry.getPath().getName() for entry in entries]
    return sorted(int(name.removeprefix("k=")) for name in names if name.startswith("k="))
