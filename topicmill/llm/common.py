"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import pickle
import sys
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.session import staged


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


#: Objects that a worker keeps; the one that was used longest ago goes for a new one.
KEPT_STATES = 2


def worker_state(key: object, make: Callable[[], object]) -> object:
    """An object of this Python worker that outlives a task; made at first use."""
    states = sys.__dict__.setdefault("_topicmill_worker_states", {})
    if key in states:
        states[key] = states.pop(key)
    else:
        while len(states) >= KEPT_STATES:
            del states[next(iter(states))]
        states[key] = make()
    return states[key]


def text_bytes(text: str | None) -> bytes:
    """The UTF-8 bytes of a text; a null text has none."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Label the nodes of an undirected graph with their component's smallest node.

    ``edges`` has long columns ``a`` and ``b``; returns ``node``, ``component`` for
    every node with an edge to another. Alternates the large-star and small-star
    steps: each replaces the edges of a node by edges to its smallest neighbour,
    so paths shorten geometrically. A round is two aggregations and joins by node;
    it ends when no edge changes. Every round is written to the shared folder.
    """
    edges = written(_ordered(edges.select("a", "b")), f"{name}-edges")
    seen = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select("m", F.col("b").alias("b"))
        large = _ordered(large.select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: each node's smaller neighbours join its smallest neighbour
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = written(_ordered(small.select("e.a", F.col("e.m").alias("b"))), f"{name}-edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b"), F.col("b")).distinct()
            )
        seen = state


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node; loops go."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


#: Removes the shuffle files of a write when it ends; what it wrote is in the shared folder.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``staged``, and the write's own shuffle files go at its end."""
    conf = df.sparkSession.conf
    before = conf.get(FILE_CLEANUP, "false")
    conf.set(FILE_CLEANUP, "true")
    try:
        return staged(df, name)
    finally:
        conf.set(FILE_CLEANUP, before)


#: Stands for a null id where rows are compared by id: before all others.
NO_ID = -(2**63)


def row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def named(rows: DataFrame) -> DataFrame:
    """``rows`` with the stand-in in ``doc_id`` made null again."""
    return rows.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, with the stand-in for null, and ``text`` alone; so ids stay whole numbers in tasks."""
    return docs.select(row_id().alias("doc_id"), F.col("text").cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df`` whatever their names, dots included."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def row_key() -> Column:
    """With the id it tells rows apart; rows with equal id and text are the same document read twice."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


class Sent:
    """A bounded object for all tasks, sent once to each executor and kept once in each worker.

    It travels by value, classes of this package too, so executors need no copy of it.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._key = f"sent {uuid.uuid4()}"
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        return worker_state(self._key, lambda: pickle.loads(self._bytes.value))
