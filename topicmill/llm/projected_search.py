"""Approximate nearest neighbours by cosine, through stable projections and a kd-tree.

Unit vectors are projected to a few dimensions by a Gaussian matrix, so a squared
projected distance over the true one follows the chi-square law. A kd-tree over the
projections has the cells of the index. A query visits the cells whose boxes its stopping
radius reaches and verifies their rows in the order of projected distance, until the
chi-square test says that a nearer row would have shown up with probability ``sure``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.llm import vector_blocks as blocks
from topicmill.llm.common import Sent, written

#: Rows that are verified between two stopping tests.
STEP = 64
SLACK = 1e-9


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))


def chi_square_point(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


class KdTree:
    """Boxes of a kd-tree over points, cut at medians of the widest direction."""

    def __init__(self, points: np.ndarray, cells: int):
        self._nodes: list = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        size = points.shape[1]
        self._grow(points, cells, np.full(size, -np.inf), np.full(size, np.inf))

    def _grow(self, points: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self._nodes)
        self._nodes.append(None)
        if cells > 1 and len(points) > 1:
            axis = int((points.max(0) - points.min(0)).argmax())
            cut = float(np.median(points[:, axis]))
            left = points[:, axis] < cut
            if 0 < left.sum() < len(points):
                below, above = high.copy(), low.copy()
                below[axis] = above[axis] = cut
                a = self._grow(points[left], cells // 2, low, below)
                b = self._grow(points[~left], cells - cells // 2, above, high)
                self._nodes[at] = (axis, cut, a, b)
                return at
        self._nodes[at] = len(self.low)
        self.low.append(low)
        self.high.append(high)
        return at

    def cells(self, points: np.ndarray) -> np.ndarray:
        found = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, members = todo.pop()
            node = self._nodes[at]
            if isinstance(node, int):
                found[members] = node
                continue
            axis, cut, a, b = node
            left = points[members, axis] < cut
            todo += [(a, members[left]), (b, members[~left])]
        return found

    def least(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of a point from each cell's box."""
        gap = np.maximum(0, np.maximum(np.array(self.low) - point, point - np.array(self.high)))
        return (gap**2).sum(1)


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with a query; equal rows give equal values wherever they stand.

    Rows and query are scaled by powers of two, which rounds nothing, so that no square
    or product overflows.
    """
    vectors, query = _scaled(vectors), _scaled(query[None])[0]
    inner = (vectors * query).sum(1)
    return inner / (np.sqrt((vectors * vectors).sum(1)) * np.sqrt((query * query).sum()))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows whose largest component lies between a half and one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1, keepdims=True))[1])


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def nearest(
    vectors: DataFrame, step: int = 50, k: int = 5, dimensions: int = 8, sure: float = 0.99, seed: int = 42
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (cosine) of each query's ``k`` nearest rows found.

    ``vectors`` has ``vec_id`` and ``embedding``. Queries are rows whose id is divisible by ``step``,
    candidates all rows with another id; repeated rows are candidates each. Vectors that are
    null, zero or hold null or non-finite components take no part. ``dimensions`` is even.
    The tree is fitted on a sample of at most ``SAMPLE`` rows and holds every row.
    """
    rows = blocks.clean(vectors, lambda v: v)

    def nonzero(values: pd.Series) -> pd.Series:
        return pd.Series(blocks.matrix(values).any(axis=1))

    rows = written(rows.filter(F.pandas_udf(nonzero, "boolean")("v")), "nearest-rows")
    ids, drawn = blocks.sample(rows)
    if not len(ids):
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    gauss = np.random.default_rng(seed).standard_normal((drawn.shape[1], dimensions))
    point = chi_square_point(sure, dimensions)
    tree = KdTree(_units(drawn) @ gauss, blocks.cells_for(rows.count()))
    sent = Sent(rows.sparkSession, (tree, gauss, ids, drawn))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["cell"] = sent.value[0].cells(_units(blocks.matrix(batch["v"])) @ sent.value[1])
                yield batch[["cell", "vec_id", "v"]]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, gauss, known, seen = sent.value
        for batch in batches:
            for who, value in zip(batch["vec_id"].tolist(), batch["v"]):
                q = np.frombuffer(value)
                others = cosines(seen[known != who], q)
                bound = float(np.sort(others)[-k]) if len(others) >= k else -1.0
                reach = point * max(0.0, 2 - 2 * bound) + SLACK
                visited = np.flatnonzero(tree.least(_units(q[None])[0] @ gauss) <= reach)
                yield pd.DataFrame({"cell": visited, "query_id": who, "v": value, "bound": bound})

    def compare(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        rows = rows.sort_values("vec_id")
        ids, vectors = rows["vec_id"].to_numpy(), blocks.matrix(rows["v"])
        gauss = sent.value[1]
        projected = _units(vectors) @ gauss
        found = []
        for who, value, bound in zip(asked["query_id"].tolist(), asked["v"], asked["bound"].tolist()):
            q = np.frombuffer(value)
            apart = ((projected - _units(q[None]) @ gauss) ** 2).sum(1)
            order = np.argsort(apart, kind="stable")
            order = order[ids[order] != who]
            best_ids, best_scores, kth = np.zeros(0, np.int64), np.zeros(0), bound
            for at in range(0, len(order), STEP):
                if apart[order[at]] > point * max(0.0, 2 - 2 * kth) + SLACK:
                    break
                part = order[at : at + STEP]
                best_ids = np.append(best_ids, ids[part])
                best_scores = np.append(best_scores, cosines(vectors[part], q))
                keep = np.lexsort((best_ids, -best_scores))[:k]
                best_ids, best_scores = best_ids[keep], best_scores[keep]
                if len(keep) == k:
                    kth = max(kth, float(best_scores[-1]))
            found.append(pd.DataFrame({"query_id": who, "vec_id": best_ids, "score": best_scores}))
        return pd.concat(found)

    placed = written(rows.mapInPandas(place, "cell long, vec_id long, v binary"), "nearest-cells")
    asked = blocks.every(rows, step).mapInPandas(ask, "cell long, query_id long, v binary, bound double")
    return blocks.search(placed, written(asked, "nearest-asked"), compare, "double", k)
