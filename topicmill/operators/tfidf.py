"""TF-IDF as ``tf * log2(N / df)`` with unit length per document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from topicmill.functions import defaults
from topicmill.operators import counts
from topicmill.operators.dictionary import id_space
from topicmill.operators.lookup import join_words
from topicmill.session import add_to_stage, remove_folder, stage_path

STORED_VECTOR = T.StructType(
    [
        T.StructField("type", T.ByteType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("indices", T.ArrayType(T.IntegerType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
)


def fit_idf(terms: DataFrame, num_docs: int) -> DataFrame:
    """Add ``idf`` to a filtered dictionary, or to its ``(token, df)``."""
    return terms.withColumn("idf", F.log2(F.lit(float(num_docs)) / F.col("df")))


def tfidf_raw(bow: DataFrame, idf: DataFrame, key: str = "token") -> DataFrame:
    """``(doc_id, key, df, weight)`` before normalising."""
    return join_words(bow, idf.select(key, "df", "idf"), key).select(
        "doc_id", key, "df", (F.col("tf") * F.col("idf")).alias("weight")
    )


def normalize(weights: DataFrame) -> DataFrame:
    """Divide by the length of each document and drop weights near zero."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("doc_id")))
    scaled = weights.filter(F.abs("weight") > defaults.WEIGHT_EPSILON).withColumn(
        "weight", F.col("weight") / norm
    )
    return scaled.filter(F.abs("weight") > defaults.WEIGHT_EPSILON)


def tfidf(bow: DataFrame, idf: DataFrame, key: str = "token") -> DataFrame:
    return normalize(tfidf_raw(bow, idf, key))


@dataclass(frozen=True)
class VectorTable:
    """A written TF-IDF matrix, one sparse row ``(doc_id, features)`` per document.

    A vector column is stored as a struct of indices and values, so the same
    files are read either as vectors for Spark ML or as plain arrays.
    """

    spark: SparkSession
    path: str
    size: int

    def _read(self, features: T.DataType) -> DataFrame:
        doc_id = self.spark.read.parquet(self.path).schema["doc_id"]
        schema = T.StructType([doc_id, T.StructField("features", features)])
        return self.spark.read.schema(schema).parquet(self.path)

    def features(self) -> DataFrame:
        return self._read(VectorUDT())

    def rows(self) -> DataFrame:
        """``(doc_id, ids, weights)``; documents without entries are left out."""
        pairs = F.filter(
            F.arrays_zip(
                F.col("features.indices").alias("i"), F.col("features.values").alias("w")
            ),
            lambda p: F.abs(p["w"]) > defaults.WEIGHT_EPSILON,
        )
        return (
            self._read(STORED_VECTOR)
            .select("doc_id", pairs.alias("pairs"))
            .filter(F.size("pairs") > 0)
            .select("doc_id", F.col("pairs.i").alias("ids"), F.col("pairs.w").alias("weights"))
        )

    def entries(self) -> DataFrame:
        """``(doc_id, token_id, weight)``."""
        zipped = F.arrays_zip(F.col("ids").alias("token_id"), F.col("weights").alias("weight"))
        return self.rows().select("doc_id", F.inline(zipped))


def tfidf_vectors(
    docs: DataFrame, dictionary: DataFrame, num_docs: int, path: str | None = None
) -> VectorTable:
    """Write the TF-IDF matrix of a corpus with one row per document."""
    return vectors_from_bags(counts.bags(docs), dictionary, num_docs, path)


def vectors_from_bags(
    found: DataFrame, dictionary: DataFrame, num_docs: int, path: str | None = None
) -> VectorTable:
    """The table from written ``bags``, so that the text is cut into words once."""
    return vectors_from_bow(counts.from_bags(found), dictionary, num_docs, path, found, written=True)


def vectors_from_bow(
    bow: DataFrame,
    dictionary: DataFrame,
    num_docs: int,
    path: str | None = None,
    docs: DataFrame | None = None,
    written: bool = False,
) -> VectorTable:
    """The table from ``(doc_id, token, tf)``: one join with the dictionary, one
    exchange by document. A ``written`` bag is not written again to be looked up."""
    table = fit_idf(dictionary, num_docs)
    weights = join_words(bow, table.select("token", "token_id", "idf"), "token", written=written).select(
        "doc_id", "token_id", (F.col("tf") * F.col("idf")).alias("weight")
    )
    return vectors_from_weights(weights, id_space(dictionary), path, docs, scale=True)


def vectors_from_weights(
    weights: DataFrame,
    size: int,
    path: str | None = None,
    docs: DataFrame | None = None,
    scale: bool = False,
) -> VectorTable:
    """The table from ``(doc_id, token_id, weight)``, optionally to unit length.

    With ``docs`` every document has a row, an empty one if none of its words count.
    Numbers alone are shuffled, once; a task sorts its documents and puts the
    entries of many of them together at a time.
    """
    entries = weights.filter(F.abs("weight") > defaults.WEIGHT_EPSILON).select(
        "doc_id", F.col("token_id").cast("int").alias("token_id"), F.col("weight").cast("double").alias("weight")
    )
    if docs is not None:  # a row without a word for each
        entries = entries.unionByName(docs.select("doc_id"), allowMissingColumns=True)
    doc_id = entries.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    ordered = entries.repartition("doc_id").sortWithinPartitions("doc_id", "token_id")
    rows = ordered.mapInArrow(lambda batches: _documents(batches, size, scale), schema)
    return _write(rows, size, path)


def _documents(batches: Iterator[pa.RecordBatch], size: int, scale: bool) -> Iterator[pa.RecordBatch]:
    """One row for each document of entries that come in its order."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        ends = np.asarray(pc.run_end_encode(held["doc_id"].combine_chunks()).run_ends)
        if len(ends) > 1:  # the last document may go on in the next batch
            yield _documents_of(held.slice(0, ends[-2]), size, scale)
            held = held.slice(ends[-2])
    if held is not None and held.num_rows:
        yield _documents_of(held, size, scale)


def _documents_of(entries: pa.Table, size: int, scale: bool) -> pa.RecordBatch:
    runs = pc.run_end_encode(entries["doc_id"].combine_chunks())
    doc = np.repeat(np.arange(len(runs.values)), np.diff(np.asarray(runs.run_ends), prepend=0))
    some = np.flatnonzero(np.asarray(pc.is_valid(entries["token_id"]).combine_chunks()))
    doc = doc[some]
    ids = entries["token_id"].take(pa.array(some)).to_numpy()
    weights = entries["weight"].take(pa.array(some)).to_numpy()
    if scale:
        weights = weights / np.sqrt(np.bincount(doc, weights * weights, len(runs.values)))[doc]
        kept = np.abs(weights) > defaults.WEIGHT_EPSILON
        doc, ids, weights = doc[kept], ids[kept], weights[kept]
    offsets = pa.array(np.searchsorted(doc, np.arange(len(runs.values) + 1)), pa.int32())
    features = pa.StructArray.from_arrays(
        [
            pa.array(np.zeros(len(runs.values), np.int8)),
            pa.array(np.full(len(runs.values), size, np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
            pa.ListArray.from_arrays(offsets, pa.array(weights, pa.float64())),
        ],
        ["type", "size", "indices", "values"],
    )
    return pa.RecordBatch.from_arrays([runs.values, features], ["doc_id", "features"])


def _write(vectors: DataFrame, size: int, path: str | None) -> VectorTable:
    spark = vectors.sparkSession
    path = path or stage_path(spark, "tfidf-vectors")
    remove_folder(spark, path)
    add_to_stage(vectors, path)
    return VectorTable(spark, path, size)
