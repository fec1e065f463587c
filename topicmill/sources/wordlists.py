"""Word lists: one-column tables ``(word)``, distinct, without empty words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topicmill.functions import defaults


def word_file(spark: SparkSession, path: str) -> DataFrame:
    """A text file with one word per line; the last line needs no newline."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def word_column(table: DataFrame, column: str | Column) -> DataFrame:
    """A lexicon table given by the user: country codes, words of a language."""
    return table.select((F.col(column) if isinstance(column, str) else column).alias("word"))


def default_stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in defaults.STOPWORDS], "word string")


def word_list(*sources: DataFrame) -> DataFrame:
    """Union of several sources as one set."""
    words = reduce(DataFrame.unionByName, [s.select("word") for s in sources])
    return words.filter(F.length("word") > 0).distinct()
