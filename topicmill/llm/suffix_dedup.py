"""Bytes of passages that occur earlier, found by suffix arrays.

Only passages whose anchor (``winnowing``) occurs twice can repeat, and of equal
stretches of text one stands for all, so the suffix arrays are built over what is left.
Stretches with the same anchor meet in a shard; a shard sorts the suffixes of its
stretches by Larsson-Sadakane refinement and takes the common prefixes of neighbours by
Kasai's bound. An anchor with too many stretches for one shard has several; their
passages are merged across shards by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.llm import winnowing
from topicmill.llm.common import free_name, named, own_columns, row_id, row_key, text_bytes, written
from topicmill.llm.word_tokens import texts_of

GRAM = 16
#: Low bits of ``run`` that hold the number of further starts in a run of passages.
RUN_BITS = 16
#: Passages that one merge group across shards should hold.
MERGE_ROWS = 200_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a byte text in their order.

    Starts from the order of the first eight bytes; each round sorts the members of
    unsettled groups by the rank of the suffix ``width`` further on, which doubles it.
    """
    size = len(text)
    x = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    for step, shift in ((1, 8), (2, 16), (4, 32)):
        x = x[:-step] << np.uint64(shift) | x[step:]
    first = x[:size]
    order = np.argsort(first, kind="stable")
    rank = np.zeros(size, np.int64)
    fresh = np.ones(size, bool)
    fresh[1:] = first[order][1:] != first[order][:-1]
    heads = np.flatnonzero(fresh)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, size)))
    width = 8
    while True:
        alone = fresh & np.append(fresh[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        members = order[slots]
        further = np.where(members + width < size, rank[np.minimum(members + width, size - 1)] + 1, 0)
        key = (rank[members].astype(np.uint64) << np.uint64(32)) | further.astype(np.uint64)
        sort = np.argsort(key, kind="stable")
        order[slots] = members[sort]
        key = key[sort]
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[slots] = new
        heads = slots[new]
        rank[order[slots]] = np.repeat(heads, np.diff(np.append(np.flatnonzero(new), len(slots))))
        width *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, stride: int = 16) -> np.ndarray:
    """Common prefix of each suffix with its predecessor in ``order``, at most ``most``.

    Kasai's bound: the suffix one byte further shares at least one byte less with its
    predecessor. Every ``stride``-th suffix is compared in full, the others from their bound.
    """
    size = len(text)
    before = np.full(size, -1)
    before[order[1:]] = order[:-1]
    padded = np.concatenate((text, np.zeros(most + 8, np.uint8)))
    shared = np.zeros(size, np.int64)

    def extend(members: np.ndarray, known: np.ndarray) -> None:
        other = before[members]
        known = np.where(other < 0, 0, known)
        busy = np.flatnonzero(other >= 0)
        while len(busy):
            p, q, l = members[busy], other[busy], known[busy]
            room = np.minimum(most, size - np.maximum(p, q))
            go = (l < room) & (padded[p + np.minimum(l, room)] == padded[q + np.minimum(l, room)])
            known[busy[go]] += 1
            busy = busy[go]
        shared[members] = known

    seeds = np.arange(0, size, stride)
    extend(seeds, np.zeros(len(seeds), np.int64))
    for step in range(1, stride):
        members = np.arange(step, size, stride)
        extend(members, np.maximum(0, shared[members - 1] - 1))
    return shared


def shard_passages(stretches: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each passage of ``length`` bytes in the stretches: stretch, start, and the first equal passage.

    Passages are numbered as returned; stretches must come in the order of the corpus.
    """
    text = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    ends = np.cumsum(sizes)
    order = suffix_array(text)
    shared = common_prefixes(text, order, length)
    group = np.zeros(len(text), np.int64)
    group[order] = np.cumsum(shared[order] < length)
    stretch = np.repeat(np.arange(len(stretches)), sizes - length + 1)
    begin = np.cumsum(sizes - length + 1) - (sizes - length + 1)
    start = np.arange(len(stretch)) - begin[stretch]
    member = group[(ends - sizes)[stretch] + start]
    _, first, where = np.unique(member, return_index=True, return_inverse=True)
    return stretch, start, first[where]


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(row_id().alias("id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text"))


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [np.frombuffer(text_bytes(t), np.uint8) for t in texts_of(batch["text"])]
            found = winnowing.find(winnowing.byte_grams, texts, length, GRAM)
            yield pd.DataFrame(
                {
                    "anchor": found.anchor,
                    "content": found.content,
                    "id": batch["id"].to_numpy()[found.doc.astype(np.int64)],
                    "row_key": batch["row_key"].to_numpy()[found.doc.astype(np.int64)],
                    "run": found.low << RUN_BITS | (found.high - found.low),
                }
            )

    return _source(docs).mapInPandas(run, "anchor long, content long, id long, row_key long, run long")


def repeated_anchors(anchors: DataFrame, name: str) -> DataFrame:
    """The runs whose anchor occurs more than once, written to the shared folder."""
    often = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    return written(anchors.join(written(often, f"{name}-often"), "anchor"), f"{name}-runs")


def removed_spans(docs: DataFrame, length: int = 100, shard_rows: int = 8192) -> DataFrame:
    """``id``, ``row_key`` and ``spans`` of the documents with bytes to remove.

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a
    document with a smaller id (null first; of equal ids by ``row_key``) or earlier in the
    same one. ``spans`` packs begin and end of each stretch (begin << 32 | end); they may
    overlap. Rows with equal id and text are one document read twice. Texts are UTF-8
    bytes; null and empty ones have none. Equal stretches are told by two 64-bit hashes.
    """
    runs = repeated_anchors(_anchors(docs, length), "suffix")
    place = F.struct("id", "row_key", "run")
    distinct = written(
        runs.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.max(place).alias("last")), "suffix-distinct"
    )
    copied = distinct.filter("first <> last").select("anchor", "content", "first")
    copies = runs.join(copied, ["anchor", "content"]).filter(place != F.col("first"))
    low, more = F.shiftright("run", RUN_BITS), F.col("run").bitwiseAND((1 << RUN_BITS) - 1)
    whole = copies.select("id", "row_key", (F.shiftleft(low, 32) + low + more + length).alias("span"))

    many = distinct.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    pieces = F.ceil(F.col("n") / shard_rows)
    shared = written(
        distinct.join(many, "anchor").select(
            "first.*",
            F.struct(F.xxhash64("anchor", F.pmod("content", pieces)).alias("shard"), (pieces > 1).alias("split")).alias("to"),
        ),
        "suffix-shared",
    )
    shards = max(1, -(-shared.count() // shard_rows))
    stretches = _stretches(docs, shared, length, shards)
    passages = written(_sharded(stretches, length), "suffix-passages")
    inside = passages.filter("span is not null").select("id", "row_key", "span")
    across = _merged(passages.filter("span is null"), length)
    spans = whole.unionByName(inside).unionByName(across)
    return written(spans.groupBy("id", "row_key").agg(F.collect_list("span").alias("spans")), "suffix-spans")


def _stretches(docs: DataFrame, shared: DataFrame, length: int, shards: int) -> DataFrame:
    """The bytes of the stretches to compare, cut from the texts, each with its shard."""
    wanted = shared.groupBy("id", "row_key").agg(F.collect_list(F.struct("run", "to.shard", "to.split")).alias("wanted"))
    texts = _source(docs).join(wanted, ["id", "row_key"]).select(
        "id", "row_key", "text", "wanted.run", "wanted.shard", "wanted.split"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, key, text, starts, shard, split in batch.itertuples(index=False):
                data = text_bytes(text)
                for r, s, p in zip(starts.tolist(), shard.tolist(), split.tolist()):
                    low = r >> RUN_BITS
                    rows.append((s % shards, p, doc, key, low, data[low : low + (r & (1 << RUN_BITS) - 1) + length]))
            yield pd.DataFrame(rows, columns=["shard", "split", "id", "row_key", "low", "bytes"])

    return texts.mapInPandas(run, "shard long, split boolean, id long, row_key long, low long, bytes binary")


def _sharded(stretches: DataFrame, length: int) -> DataFrame:
    """Spans to remove, and of split anchors each first passage with its digest (no span)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["id", "row_key", "low"]).sort_values(["id", "row_key", "low"])
        data = group["bytes"].tolist()
        stretch, start, first = shard_passages(data, length)
        here = np.arange(len(stretch))
        at = group["low"].to_numpy()[stretch] + start
        again = here[first < here]
        opens = np.ones(len(again), bool)
        opens[1:] = (np.diff(again) > 1) | (np.diff(stretch[again]) != 0)
        heads = again[opens]
        tails = again[np.append(np.flatnonzero(opens)[1:], len(again)) - 1] if len(again) else again
        spans = pd.DataFrame(
            {
                "id": group["id"].to_numpy()[stretch[heads]],
                "row_key": group["row_key"].to_numpy()[stretch[heads]],
                "span": pd.array(at[heads] << 32 | at[tails] + length, dtype="Int64"),
                "digest": pd.array(np.zeros(len(heads), np.int64), dtype="Int64"),
                "low": at[heads],
            }
        )
        only = here[(first == here) & group["split"].to_numpy()[stretch]]
        digests = [
            int.from_bytes(hashlib.blake2b(data[s][b : b + length], digest_size=8).digest(), "little", signed=True)
            for s, b in zip(stretch[only].tolist(), start[only].tolist())
        ]
        firsts = pd.DataFrame(
            {
                "id": group["id"].to_numpy()[stretch[only]],
                "row_key": group["row_key"].to_numpy()[stretch[only]],
                "span": pd.array([None] * len(only), dtype="Int64"),
                "digest": pd.array(digests, dtype="Int64"),
                "low": at[only],
            }
        )
        return pd.concat((spans, firsts))

    return stretches.groupBy("shard").applyInPandas(run, "id long, row_key long, span long, digest long, low long")


def _merged(passages: DataFrame, length: int) -> DataFrame:
    """Spans of passages that an earlier shard-first passage with the same digest precedes."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        digest = group["digest"].to_numpy(np.int64)
        order = np.lexsort((group["low"], group["row_key"], group["id"], digest))
        digest = digest[order]
        later = order[np.searchsorted(digest, digest, "left") < np.arange(len(digest))]
        low = group["low"].to_numpy()[later]
        ids, keys = group["id"].to_numpy()[later], group["row_key"].to_numpy()[later]
        return pd.DataFrame({"id": ids, "row_key": keys, "span": low << 32 | low + length})

    groups = max(1, -(-passages.count() // MERGE_ROWS))
    sliced = passages.withColumn("slice", F.pmod("digest", F.lit(groups)))
    return sliced.groupBy("slice").applyInPandas(run, "id long, row_key long, span long")


def with_spans(docs: DataFrame, spans: DataFrame, column: str) -> DataFrame:
    """``docs`` with the packed spans of each row in ``column``, null where nothing is removed."""
    number, key = free_name(docs, "id"), free_name(docs, "row_key")
    keyed = docs.withColumn(number, row_id()).withColumn(key, row_key())
    found = spans.select(F.col("id").alias(number), F.col("row_key").alias(key), F.col("spans").alias(column))
    return keyed.join(found, [number, key], "left").select(*own_columns(docs), column)


def runs_of(spans: np.ndarray | None) -> list[tuple[int, int]]:
    """Packed spans as maximal runs in order."""
    if spans is None or not len(spans):
        return []
    packed = np.sort(np.asarray(spans, np.int64))
    begin, end = packed >> 32, np.maximum.accumulate(packed & 0xFFFFFFFF)
    opens = np.append(True, begin[1:] > end[:-1])
    closes = np.append(np.flatnonzero(opens)[1:], len(begin)) - 1
    return list(zip(begin[opens].tolist(), end[closes].tolist()))


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def kept_text(text: str, runs: list[tuple[int, int]]) -> str:
    """A text without the whole characters of some runs of its bytes; a character that a run
    only touches stays."""
    data, whole = text_bytes(text), []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        whole.append((a, b))
    return kept_bytes(data, whole).decode("utf-8", "surrogatepass")


def digests(docs: DataFrame, length: int = 100, shard_rows: int = 8192) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row.

    Cases as in ``removed_spans``; repeated rows give a row each, an empty table none.
    """
    joined = with_spans(docs.select("doc_id", "text"), removed_spans(docs, length, shard_rows), "spans")
    joined = joined.select(row_id().alias("doc_id"), F.col("text").cast("string").alias("text"), "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spans in zip(texts_of(batch["text"]), batch["spans"]):
                data, runs = text_bytes(text), runs_of(spans)
                gone = sum(b - a for a, b in runs)
                rows.append((len(data), gone, len(runs), hashlib.sha256(kept_bytes(data, runs)).hexdigest()))
            frame = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return named(joined.mapInPandas(run, schema))


def deduplicated(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with repeated bytes cut from ``text``; all rows and columns stay.

    A character that is only partly repeated stays whole, so none is made up; a null text
    stays null and a text that repeats whole becomes empty.
    """

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        kept = []
        for text, packed in zip(texts_of(texts), spans):
            runs = runs_of(packed)
            kept.append(kept_text(text, runs) if runs else text)
        return pd.Series(kept, dtype="object")

    spans = free_name(docs, "spans")
    trim: Column = F.pandas_udf(cut, "string")(F.col("text").cast("string"), F.col(spans))
    return with_spans(docs, removed_spans(docs, length), spans).withColumn("text", trim).drop(spans)
