"""Cut documents into segments by accumulated size."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from topicmill.functions import defaults
from topicmill.session import staged

# Lines of a document that are handled as one row when looking for cuts.
LINES_PER_BLOCK = 50_000


# Children of a node in the tree over a document's blocks.
FAN = 8

_JUMPS = "at array<bigint>, opened array<bigint>, leave array<bigint>"


@dataclass(frozen=True)
class _Jumps:
    """How a stretch of lines changes the running segment.

    The segment that enters ends at the first line that lies more than ``threshold`` bytes
    behind the start of the stretch. ``at`` holds the offsets of the lines that can be this
    line; from each of them ``opened`` segments begin in the stretch, and the last of them
    leaves it with the threshold ``leave``, counted from the end. Thresholds are at most
    the limit, so offsets beyond it are not needed, but for the first.
    """

    total: int
    at: np.ndarray
    opened: np.ndarray
    leave: np.ndarray

    @staticmethod
    def of_lines(sizes: np.ndarray, limit: int) -> _Jumps:
        before = np.cumsum(sizes) - sizes
        total, at = int(sizes.sum()), np.unique(before)
        # Each line jumps to the one that ends its segment; doubling the jumps reaches the
        # last in as many rounds as the number of segments has digits. The end stands still.
        step = np.append(np.searchsorted(at, at + limit, side="right"), len(at))
        opened, last = np.append(np.ones(len(at), dtype=np.int64), 0), np.arange(len(at) + 1)
        while (step[:-1] < len(at)).any():
            opened = opened + opened[step]
            last = np.where(step < len(at), last[step], last)
            step = step[step]
        return _Jumps(total, at, opened[:-1], at[last[:-1]] + limit - total)._cut(limit)

    def _cut(self, limit: int) -> _Jumps:
        kept = int(np.searchsorted(self.at, limit, side="right")) + 1
        return _Jumps(self.total, self.at[:kept], self.opened[:kept], self.leave[:kept])

    def after(self, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segments that begin in the stretch and the threshold behind it, for each threshold."""
        place = np.searchsorted(self.at, thresholds, side="right")
        opened, leave = np.append(self.opened, 0), np.append(self.leave, 0)
        return opened[place], np.where(place < len(self.at), leave[place], thresholds - self.total)

    def then(self, other: _Jumps, limit: int) -> _Jumps:
        """This stretch and the one behind it as one."""
        opened, leave = other.after(self.leave)
        return _Jumps(
            self.total + other.total,
            np.concatenate([self.at, other.at + self.total]),
            np.concatenate([self.opened + opened, other.opened]),
            np.concatenate([leave, other.leave]),
        )._cut(limit)


def _of_rows(rows: pd.DataFrame) -> list[_Jumps]:
    """The jumps of some nodes in the order of the document."""
    rows = rows.sort_values("node")
    return [_Jumps(*found) for found in zip(rows["total"], rows["at"], rows["opened"], rows["leave"])]


def _leaves(blocks: DataFrame, limit: int, doc_id: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [_Jumps.of_lines(np.asarray(sizes, dtype=np.int64), limit) for sizes in batch["sizes"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "node": batch["block"],
                    "total": [f.total for f in found],
                    "at": [f.at for f in found],
                    "opened": [f.opened for f in found],
                    "leave": [f.leave for f in found],
                }
            )

    sizes = blocks.select("doc_id", "block", F.col("lines.s").alias("sizes"))
    return sizes.mapInPandas(run, f"doc_id {doc_id}, node bigint, total bigint, {_JUMPS}")


def _parents(nodes: DataFrame, limit: int, doc_id: str) -> DataFrame:
    """The nodes a level up; a task puts together the jumps of ``FAN`` children."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole = reduce(lambda left, right: left.then(right, limit), _of_rows(rows))
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].iloc[:1],
                "node": [int(rows["node"].iloc[0]) // FAN],
                "total": [whole.total],
                "at": [whole.at],
                "opened": [whole.opened],
                "leave": [whole.leave],
            }
        )

    parent = F.floor(F.col("node") / F.lit(FAN)).cast("bigint")
    grouped = nodes.groupBy("doc_id", parent.alias("parent"))
    return grouped.applyInPandas(run, f"doc_id {doc_id}, node bigint, total bigint, {_JUMPS}")


def _entered(nodes: DataFrame, above: DataFrame, doc_id: str) -> DataFrame:
    """``(doc_id, node, threshold, base)``: what enters each node, from what enters its parent."""

    def run(rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        threshold, base, found = int(entry["threshold"].iloc[0]), int(entry["base"].iloc[0]), []
        for node, jumps in zip(sorted(rows["node"]), _of_rows(rows)):
            found.append((rows["doc_id"].iloc[0], node, threshold, base))
            opened, leave = jumps.after(np.array([threshold]))
            threshold, base = int(leave[0]), base + int(opened[0])
        return pd.DataFrame(found, columns=["doc_id", "node", "threshold", "base"])

    parent = F.floor(F.col("node") / F.lit(FAN)).cast("bigint")
    below = nodes.withColumn("parent", parent).groupBy("doc_id", "parent")
    entries = above.withColumnRenamed("node", "parent").groupBy("doc_id", "parent")
    schema = f"doc_id {doc_id}, node bigint, threshold bigint, base bigint"
    return below.cogroup(entries).applyInPandas(run, schema)


def _entries(blocks: DataFrame, limit: int, doc_id: str) -> DataFrame:
    """``(doc_id, block, threshold, base)``: how far the segment that enters a block may
    reach into it, and its number.

    A tree over the blocks of each document: jumps are put together upwards and followed
    downwards, so that tasks share a document, whatever its length.
    """
    last = blocks.agg(F.max("block")).first()[0] or 0
    levels = []
    while last > 0:
        nodes = _parents(levels[-1], limit, doc_id) if levels else _leaves(blocks, limit, doc_id)
        levels.append(staged(nodes, "jumps"))
        last //= FAN
    tops = blocks.select("doc_id").distinct().withColumn("node", F.lit(0).cast("bigint"))
    entered = tops.withColumn("threshold", F.lit(limit).cast("bigint")).withColumn("base", F.lit(0).cast("bigint"))
    for nodes in reversed(levels):
        entered = staged(_entered(nodes, entered, doc_id), "entries")
    return entered.withColumnRenamed("node", "block")


def _cuts(batches, limit: int):
    """The lines that open a segment in each block."""
    for batch in batches:
        starts = []
        for sizes, threshold in zip(batch["sizes"], batch["threshold"]):
            before = np.cumsum(np.asarray(sizes, dtype=np.int64)) - np.asarray(sizes, dtype=np.int64)
            opened = []
            while (at := int(np.searchsorted(before, threshold, side="right"))) < len(before):
                opened.append(at)
                threshold = int(before[at]) + limit
            starts.append(opened)
        yield batch[["doc_id", "block", "base"]].assign(starts=starts)


def split_documents(
    lines: DataFrame,
    order: str,
    limit: int = defaults.SPLIT_BYTES,
    newline_bytes: int = 0,
    lines_per_block: int = LINES_PER_BLOCK,
) -> DataFrame:
    """Add ``segment`` to ``(doc_id, order, text)``, counted from 0.

    ``order`` is a non-negative line number. Text lines that lost their newline
    get it counted back with ``newline_bytes=1``. No line is lost, and no task
    holds the text of a document or walks all its lines: texts stay where they are
    and are joined with their block's cuts. A null id has no segments and is left out.
    """
    placed = lines.withColumn(
        "block", F.floor(F.col(order) / F.lit(lines_per_block)).cast("bigint")
    )
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(newline_bytes)).cast("bigint")
    packed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("n"), size.alias("s"))))
    blocks = staged(placed.groupBy("doc_id", "block").agg(packed.alias("lines")), "line_sizes")
    doc_id = lines.schema["doc_id"].dataType.simpleString()
    walked = (
        blocks.join(_entries(blocks, limit, doc_id), ["doc_id", "block"])
        .select("doc_id", "block", "base", "threshold", F.col("lines.s").alias("sizes"))
        .mapInPandas(
            lambda batches: _cuts(batches, limit),
            f"doc_id {doc_id}, block bigint, base bigint, starts array<int>",
        )
    )
    opened = blocks.join(walked, ["doc_id", "block"]).select(
        "doc_id",
        "block",
        "base",
        F.transform("starts", lambda at: F.get(F.col("lines.n"), at)).alias("starts"),
    )
    passed = F.filter("starts", lambda start: start <= F.col(order))
    return (
        placed.join(opened, ["doc_id", "block"])
        .withColumn("segment", F.col("base") + F.size(passed))
        .drop("block", "base", "starts")
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """``(doc_id, line_no, text)`` for lines read from files.

    A line number is the place in the file split plus the lines of the splits
    before, of which a file has few.
    """
    splits = lines.groupBy("doc_id", "split_start").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = (
        Window.partitionBy("doc_id")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = splits.select(
        "doc_id",
        "split_start",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("offset"),
    )
    return lines.join(offsets, ["doc_id", "split_start"]).select(
        "doc_id", (F.col("place") + F.col("offset")).alias("line_no"), "text"
    )


def as_documents(segments: DataFrame) -> DataFrame:
    """Lines under the id of their segment, ``doc_id#segment``."""
    return segments.withColumn("doc_id", F.concat_ws("#", "doc_id", "segment"))
