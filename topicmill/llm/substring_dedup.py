"""Words of passages that occur more than once, by a compacted de Bruijn graph.

The edges are all windows of ``window`` words. Consecutive edges with the same anchor
(``winnowing``) form a path without a branch; it is compacted in the task that reads the
text, so a path is one row. A join on anchor and content makes one path of all equal
ones, with its number of sources. Where different paths share an anchor the graph
branches: one source of each is opened into its edges again, and a join on the edge
finds those that several paths contain. Paths and edges carry their document and place;
from these coordinates repeated stretches are put together and taken out of the words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.llm import winnowing
from topicmill.llm.common import free_name, named, row_id, row_key, text_bytes, worker_state, written
from topicmill.llm.suffix_dedup import RUN_BITS, repeated_anchors, runs_of, with_spans
from topicmill.llm.word_tokens import texts_of

#: Words of an anchor.
GRAM = 8
#: Bytes that are cut into words at once; a part ends with a whole word.
PART = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Longer words are hashed one by one.
LONG_WORD = 256


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``size`` of them."""
    known = worker_state("word hash powers", dict)
    if size > known.get("size", 0):
        known["size"] = size = max(size, 1 << 16)
        known["up"] = winnowing._powers(winnowing.BASE, size)
        known["down"] = winnowing._powers(winnowing.INVERSE, size)
    return known["up"], known["down"]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word in order."""
    parts, begin = [], 0
    while begin < len(data):
        end = begin + PART
        if end < len(data):
            blank = BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        parts.append(_part_hashes(data[begin:end]))
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _part_hashes(data: bytes) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)
    solid = np.zeros(len(x) + 2, np.int8)
    solid[1:-1] = (x != 32) & ((x < 9) | (x > 13))
    edge = np.diff(solid)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(x) + 1)
    totals = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum((x + np.uint64(1)) * down[: len(x)], dtype=np.uint64))
    )
    length = (ends - starts).astype(np.uint64)
    found = winnowing.mix(winnowing.mix((totals[ends] - totals[starts]) * up[starts]) + length)
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
        found[i] = int.from_bytes(digest, "little")
    return found


def edge_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit hash of each window of word hashes."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(words) + 1)
    totals = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * down[: len(words)], dtype=np.uint64)))
    return winnowing.mix((totals[window:] - totals[:-window]) * up[: len(words) - window + 1])


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(row_id().alias("id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text"))


def _paths(docs: DataFrame, window: int) -> DataFrame:
    """One row for each path of consecutive edges with one anchor."""
    gram = min(GRAM, window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [word_hashes(text_bytes(t)) for t in texts_of(batch["text"])]
            found = winnowing.find(lambda w: winnowing.word_grams(w, gram), words, window, gram)
            doc = found.doc.astype(np.int64)
            yield pd.DataFrame(
                {
                    "anchor": found.anchor,
                    "content": found.content,
                    "id": batch["id"].to_numpy()[doc],
                    "row_key": batch["row_key"].to_numpy()[doc],
                    "run": found.low << RUN_BITS | (found.high - found.low),
                }
            )

    return _source(docs).mapInPandas(run, "anchor long, content long, id long, row_key long, run long")


def repeated_paths(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """All sources of paths whose anchor repeats, and the distinct paths with their sources counted.

    Of the distinct ones, ``first`` is the source with the smallest id and place.
    """
    paths = repeated_anchors(_paths(docs, window), "debruijn")
    place = F.struct("id", "row_key", "run")
    distinct = paths.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.count("*").alias("sources"))
    return paths, written(distinct, "debruijn-paths")


def _edges(docs: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """Edges of one source of each path at a branch, with the number of sources of the path."""
    branches = distinct.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    opened = distinct.join(branches, "anchor").select("first.*", "sources")
    wanted = opened.groupBy("id", "row_key").agg(F.collect_list(F.struct("run", "sources")).alias("wanted"))
    # a repeated row's paths have two sources or more; opening it twice only adds to their number
    texts = _source(docs).join(wanted, ["id", "row_key"]).select("id", "row_key", "text", "wanted.run", "wanted.sources")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for doc, key, text, runs, sources in batch.itertuples(index=False):
                edges = edge_hashes(word_hashes(text_bytes(text)), window).view(np.int64)
                low, more = runs >> RUN_BITS, runs & (1 << RUN_BITS) - 1
                total = np.cumsum(more + 1)
                places = np.arange(total[-1]) - np.repeat(total - more - 1, more + 1) + np.repeat(low, more + 1)
                frame = pd.DataFrame({"edge": edges[places], "place": places, "sources": np.repeat(sources, more + 1)})
                frame["id"], frame["row_key"] = doc, key
                found.append(frame)
            if found:
                yield pd.concat(found)[["edge", "id", "row_key", "place", "sources"]]

    return texts.mapInPandas(run, "edge long, id long, row_key long, place long, sources long")


def repeated_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """``id``, ``row_key`` and ``spans`` (begin << 32 | end, in words) of documents with repeated words.

    A word goes if a window that covers it has the same words as a window that starts
    anywhere else, in the same document too; every copy goes. Words are cut at ASCII blanks
    and compared as they are. A repeated row counts as another document. Null and empty
    texts have no words. Paths and edges are told by 64-bit hashes beside the anchor's.
    """
    paths, distinct = repeated_paths(docs, window)
    low, more = F.shiftright("run", RUN_BITS), F.col("run").bitwiseAND((1 << RUN_BITS) - 1)
    packed = F.shiftleft(low, 32) + low + more + window
    repeated = distinct.filter("sources > 1").select("anchor", "content")
    whole = paths.join(repeated, ["anchor", "content"]).select("id", "row_key", packed.alias("span"))

    edges = written(_edges(docs, distinct, window), "debruijn-edges")
    often = edges.groupBy("edge").agg(F.sum("sources").alias("n")).filter("n > 1").select("edge")
    at = F.col("place")
    single = edges.filter("sources = 1").join(often, "edge")
    parts = single.select("id", "row_key", (F.shiftleft(at, 32) + at + window).alias("span"))
    spans = whole.unionByName(parts)
    return written(spans.groupBy("id", "row_key").agg(F.collect_set("span").alias("spans")), "debruijn-spans")


def kept_words(words: list[bytes], runs: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for begin, end in runs:
        kept += words[at:begin]
        at = end
    return kept + words[at:]


def digests(docs: DataFrame, window: int = 35) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every row.

    Cases as in ``repeated_spans``; repeated rows give a row each, an empty table none;
    other columns are ignored.
    """
    joined = with_spans(docs.select("doc_id", "text"), repeated_spans(docs, window), "spans")
    joined = joined.select(row_id().alias("doc_id"), F.col("text").cast("string").alias("text"), "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spans in zip(texts_of(batch["text"]), batch["spans"]):
                words, runs = text_bytes(text).split(), runs_of(spans)
                kept = kept_words(words, runs) if runs else words
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            frame = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return named(joined.mapInPandas(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def deduplicated(docs: DataFrame, window: int = 35) -> DataFrame:
    """``docs`` with repeated words cut from ``text``; all rows and columns stay.

    Texts that lose words have the rest joined by one space; others stay as they are.
    """

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        found = []
        for text, packed in zip(texts_of(texts), spans):
            runs = runs_of(packed)
            found.append(b" ".join(kept_words(text_bytes(text).split(), runs)).decode() if runs else text)
        return pd.Series(found, dtype="object")

    spans = free_name(docs, "spans")
    trim: Column = F.pandas_udf(cut, "string")(F.col("text").cast("string"), F.col(spans))
    return with_spans(docs, repeated_spans(docs, window), spans).withColumn("text", trim).drop(spans)
