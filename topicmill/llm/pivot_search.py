"""Exact search for the largest integer inner products by a pivot-distance index.

With one more component that brings every row to the length of the longest, the nearest
rows are those with the largest inner product. Rows are keyed by their nearest pivot and
their distance from it and cut to annuli. A query's k-th best score among a sample bounds
its radius; it visits the annuli in the order of the least distance that the triangle
inequality leaves them, and stops at the first beyond the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.llm import vector_blocks as blocks
from topicmill.llm.common import Sent, written


@dataclass
class Index:
    """Pivots with their added component, and the inner edges of each pivot's annuli."""

    longest: float
    pivots: np.ndarray
    added: np.ndarray
    edges: list[np.ndarray]

    def distances(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Distance of each vector from each pivot; a query's added component is zero."""
        squares = (vectors**2).sum(1)
        added = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.longest - squares))
        length = squares + added**2
        inner = vectors @ self.pivots.T + added[:, None] * self.added
        return np.sqrt(np.maximum(0, length[:, None] + self.longest - 2 * inner))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        distance = self.distances(vectors, False)
        nearest = distance.argmin(1)
        first = np.cumsum([0] + [len(e) + 1 for e in self.edges])
        own = distance[np.arange(len(vectors)), nearest]
        ring = np.zeros(len(vectors), np.int64)
        for p in np.unique(nearest).tolist():
            at = nearest == p
            ring[at] = np.searchsorted(self.edges[p], own[at], "right")
        return first[nearest] + ring

    def annuli(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pivot, inner and outer edge of each cell."""
        pivot = np.concatenate([np.full(len(e) + 1, p) for p, e in enumerate(self.edges)])
        inner = np.concatenate([np.append(0.0, e) for e in self.edges])
        outer = np.concatenate([np.append(e, np.inf) for e in self.edges])
        return pivot, inner, outer


def fit(vectors: np.ndarray, longest: float, count: int, pivots: int = 16) -> Index:
    """Pivots far apart, and annuli with like shares of the sample."""
    squares = (vectors**2).sum(1)
    added = np.sqrt(np.maximum(0, longest - squares))
    whole = np.concatenate((vectors, added[:, None]), axis=1)
    chosen = [0]
    apart = ((whole - whole[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(whole)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((whole - whole[chosen[-1]]) ** 2).sum(1))
    index = Index(longest, vectors[chosen], added[chosen], [np.zeros(0)] * len(chosen))
    distance = index.distances(vectors, False)
    nearest = distance.argmin(1)
    for p in range(len(chosen)):
        own = np.sort(distance[nearest == p, p])
        rings = max(1, round(blocks.cells_for(count) * len(own) / len(vectors)))
        index.edges[p] = np.unique(own[(np.arange(1, rings) * len(own)) // rings]) if rings > 1 else np.zeros(0)
    return index


def whole_numbers(vectors: np.ndarray, factor: float) -> np.ndarray:
    return np.floor(factor * vectors)


def top_products(vectors: DataFrame, step: int = 20, k: int = 20, factor: float = 64.0) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's ``k`` largest inner products.

    ``vectors`` has ``vec_id`` and ``embedding``; components become floor(factor * x). Queries are
    rows whose id is divisible by ``step``, candidates all other rows (of one id none is its own
    candidate; repeated rows are candidates each). Vectors null or with null or non-finite
    components take no part; other columns are ignored; no rows give no rows. The scores are
    exact while squared lengths stay below 2^53.
    """
    rows = written(
        blocks.clean(vectors, lambda v: whole_numbers(v, factor)), "products-rows"
    )
    ids, drawn = blocks.sample(rows)
    if not len(ids):
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        )

    def longest(values: pd.Series) -> pd.Series:
        return pd.Series((blocks.matrix(values) ** 2).sum(1))

    most, count = rows.agg(F.max(F.pandas_udf(longest, "double")("v")), F.count("*")).first()
    sent = Sent(rows.sparkSession, (fit(drawn, most, count), ids, drawn))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["cell"] = sent.value[0].cells(blocks.matrix(batch["v"]))
                yield batch[["cell", "vec_id", "v"]]

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, known, seen = sent.value
        pivot, inner, outer = index.annuli()
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.iloc[at : at + 256]
                q = blocks.matrix(batch["v"])
                scores = np.where(batch["vec_id"].to_numpy()[:, None] == known, -np.inf, q @ seen.T)
                bound = np.sort(scores, axis=1)[:, -k] if len(known) > k else np.full(len(q), -np.inf)
                away = index.distances(q, True)[:, pivot]
                least = np.maximum(0, np.maximum(inner - away, away - outer))
                reach = np.sqrt(np.maximum(0, (q**2).sum(1) + index.longest - 2 * bound))
                for i in range(len(batch)):
                    order = np.argsort(least[i], kind="stable")
                    far = np.searchsorted(least[i][order], reach[i] * (1 + 1e-9) + 1e-6, "right")
                    visited = np.sort(order[:far])
                    row = batch.iloc[i]
                    yield pd.DataFrame(
                        {"cell": visited, "query_id": row["vec_id"], "v": row["v"], "bound": bound[i]}
                    )

    def compare(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if not len(rows) or not len(asked):
            return empty
        rows = rows.sort_values("vec_id")
        ids, vectors = rows["vec_id"].to_numpy(), blocks.matrix(rows["v"])
        found = [empty]
        for at in range(0, len(asked), 256):
            some = asked.iloc[at : at + 256]
            scores = blocks.matrix(some["v"]) @ vectors.T
            scores[some["query_id"].to_numpy()[:, None] == ids] = -np.inf
            scores[scores < some["bound"].to_numpy()[:, None]] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            who, rank = np.nonzero(np.take_along_axis(scores, best, 1) > -np.inf)
            at_row = best[who, rank]
            found.append(
                pd.DataFrame(
                    {
                        "query_id": some["query_id"].to_numpy()[who],
                        "vec_id": ids[at_row],
                        "score": scores[who, at_row].astype(np.int64),
                    }
                )
            )
        return pd.concat(found)

    placed = written(rows.mapInPandas(place, "cell long, vec_id long, v binary"), "products-cells")
    asked = blocks.every(rows, step).mapInPandas(ask, "cell long, query_id long, v binary, bound double")
    return blocks.search(placed, written(asked, "products-asked"), compare, "long", k)
