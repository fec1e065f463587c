"""Near duplicates by SimHash fingerprints and vantage-point trees over Hamming distance.

Equal fingerprints are one node. A vantage-point tree is built on a bounded sample of
nodes; its leaves are shards. Every node lives in one shard and also visits the shards
with a smaller number that the triangle inequality cannot rule out: at a vantage point
with split distance ``m``, partners of a node at distance ``d`` can lie inside only if
``d - bits <= m`` and outside only if ``d + bits > m``. A shard finds its exact pairs by a
tree of its own and returns links that keep each node connected, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.llm.common import components, free_name, named, own_columns, row_id, row_key, text_bytes, written
from topicmill.llm.word_tokens import texts_of

#: Nodes that a shard should hold at most, shards that a tree has where there are nodes for them, and
#: its most shards; the last bounds the tree that is sent. Fewer shards mean fewer visits.
SHARD_NODES = 65_536
LEAST_SHARDS = 32
MOST_SHARDS = 4096
#: Nodes that the shared tree is built on at most.
SAMPLE = 65_536
#: Nodes of a leaf of the tree inside a shard.
LEAF = 128


def fingerprint(text: str | None, shingle: int) -> int:
    """64 majority bits of the XXH64 values of a text's word shingles, as an unsigned integer."""
    import xxhash

    words = text_bytes(text).lower().split()
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[: count - 1])]
    ends = ends[min(shingle, len(words)) - 1 :]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, count, 65_536):
        spans = zip(starts[at : at + 65_536], ends[at : at + 65_536])
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
        total += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, ``row_key`` (a hash of id and text) and ``fp`` of every row of ``docs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [fingerprint(t, shingle) for t in texts_of(batch["text"])]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "row_key": batch["row_key"],
                    "fp": np.array(values, np.uint64).view(np.int64),
                }
            )

    source = docs.select(row_id().alias("doc_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text"))
    return named(source.mapInPandas(run, "doc_id long, row_key long, fp long"))


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def _vantage(nodes: np.ndarray) -> tuple[np.uint64, int]:
    """The candidate whose distances spread most, and their median."""
    step = max(1, len(nodes) // 16)
    seen = nodes[:: max(1, len(nodes) // 512)]
    best = max(nodes[::step][:16], key=lambda v: float(_distance(seen, v).std()))
    distances = _distance(nodes, best)
    median = int(np.median(distances))
    # ties at the median: take the even cut
    if 2 * (distances < median).sum() > len(nodes) - 2 * (distances > median).sum() and median:
        median -= 1
    return best, median


class ShardTree:
    """The vantage-point tree whose leaves are the shards."""

    def __init__(self, nodes: np.ndarray, shards: int):
        self._nodes: list[tuple | int] = []
        self.shards = 0
        self._grow(nodes, shards)

    def _grow(self, nodes: np.ndarray, shards: int) -> int:
        at = len(self._nodes)
        self._nodes.append(-1)
        if shards > 1 and len(nodes) > 1:
            point, split = _vantage(nodes)
            inside = _distance(nodes, point) <= split
            if 0 < inside.sum() < len(nodes):
                a = self._grow(nodes[inside], shards // 2)
                b = self._grow(nodes[~inside], shards // 2)
                self._nodes[at] = (point, split, a, b)
                return at
        self._nodes[at] = self.shards
        self.shards += 1
        return at

    def reach(self, nodes: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each shard with the indexes of ``nodes`` that may have partners there, and which live there."""
        todo = [(0, np.arange(len(nodes)), np.ones(len(nodes), bool))]
        while todo:
            at, members, home = todo.pop()
            if not len(members):
                continue
            node = self._nodes[at]
            if isinstance(node, int):
                yield node, members, home
                continue
            point, split, a, b = node
            d = _distance(nodes[members], point)
            near, far = d - bits <= split, d + bits > split
            todo.append((a, members[near], home[near] & (d <= split)[near]))
            todo.append((b, members[far], home[far] & (d > split)[far]))


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a[i]`` and ``b[i]``; roots are the smallest members."""
    while len(a):
        for side in (a, b):
            while True:
                up = parent[side]
                if (up == side).all():
                    break
                side[:] = up
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def shard_links(nodes: np.ndarray, home: np.ndarray, bits: int) -> np.ndarray:
    """For each node the index of its set's root; nodes within ``bits`` of a home node share its set."""
    parent = np.arange(len(nodes))
    todo = [(np.flatnonzero(home), np.arange(len(nodes)))]
    while todo:
        homes, asking = todo.pop()
        if not len(homes) or not len(asking):
            continue
        if len(homes) > LEAF:
            point, split = _vantage(nodes[homes])
            d = _distance(nodes[homes], point)
            inside = d <= split
            if 0 < inside.sum() < len(homes):
                q = _distance(nodes[asking], point)
                todo.append((homes[inside], asking[q - bits <= split]))
                todo.append((homes[~inside], asking[q + bits > split]))
                continue
        for at in range(0, len(homes), LEAF):
            some = homes[at : at + LEAF]
            for begin in range(0, len(asking), 8192):
                part = asking[begin : begin + 8192]
                i, j = np.nonzero(np.bitwise_count(nodes[part][:, None] ^ nodes[some][None, :]) <= bits)
                apart = part[i] != some[j]
                _unite(parent, part[i][apart], some[j][apart])
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def links(nodes: DataFrame, bits: int) -> DataFrame:
    """Edges ``a``, ``b`` between distinct values of ``fp`` that connect all pairs within ``bits``."""
    count = nodes.count()
    wanted = max(count // SHARD_NODES, min(LEAST_SHARDS, count // (2 * LEAF)), 1)
    shards = min(MOST_SHARDS, 1 << (wanted - 1).bit_length())
    drawn = [r[0] for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, 256 * shards)).collect()]
    tree = ShardTree(np.array(drawn, np.int64).view(np.uint64), shards)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            where = list(tree.reach(fps.view(np.uint64), bits))
            own = np.zeros(len(fps), np.int64)
            for shard, members, home in where:
                own[members[home]] = shard
            for shard, members, home in where:
                sent = own[members] >= shard
                yield pd.DataFrame({"shard": shard, "fp": fps[members[sent]], "home": home[sent]})

    def connect(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy(np.int64)
        parent = shard_links(fps.view(np.uint64), group["home"].to_numpy(bool), bits)
        linked = np.flatnonzero(parent != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked], "b": fps[parent[linked]]})

    routed = nodes.select("fp").mapInPandas(route, "shard int, fp long, home boolean")
    return routed.groupBy("shard").applyInPandas(connect, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """Fingerprint and group of every row of ``docs`` (``doc_id``, ``text``).

    Returns ``doc_id``, ``row_key``, ``fp``, ``group`` (one value for all rows that chains of
    fingerprints at most ``bits`` apart connect) and ``component_id``, the group's smallest
    ``doc_id``, null only if the group has no other. Texts without words have fingerprint
    zero and are linked like any other. Repeated rows are rows of one group; a null id is a
    row like any other; an empty table gives no rows; other columns are ignored.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    grouped = components(links(nodes, bits), "simhash")
    labelled = nodes.join(grouped, nodes["fp"] == grouped["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group")
    )
    labelled = written(labelled, "fingerprint-groups")
    smallest = labelled.groupBy("group").agg(F.min("least").alias("component_id"))
    return rows.join(labelled.join(smallest, "group").select("fp", "group", "component_id"), "fp")


def representatives(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """The row of ``docs`` with the smallest id of each near-duplicate group, all its columns.

    Rows without an id stand behind all others; of repeated rows one stays.
    """
    found = near_duplicates(docs, shingle, bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    key, kept_id = free_name(docs, "row_key"), free_name(docs, "kept_id")
    kept = found.groupBy("group").agg(first.alias("first")).select(
        F.col("first.doc_id").alias(kept_id), F.col("first.row_key").alias(key)
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id))
    chosen = docs.withColumn(key, row_key()).join(written(kept, "fingerprint-kept"), key).filter(same).drop(kept_id)
    return chosen.dropDuplicates([key]).drop(key).select(*own_columns(docs))
