"""What the two vector searches share: clean vectors, blocks of rows and queries, best results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a block, and queries that meet it at once.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 4096
#: Rows that an index is fitted on at most; they also give each query its first bound.
SAMPLE = 4096
#: Cells of an index at most; bounds what is sent to the tasks.
MOST_CELLS = 4096


def clean(vectors: DataFrame, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``vec_id`` and ``v`` (``change`` of the vector as 64-bit floats, in bytes).

    Vectors that are null or hold a null or non-finite component, and rows without an id,
    are left out; shorter vectors count as filled with zeros.
    """
    whole = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter(
        F.col("vec_id").isNotNull() & whole
    )
    size = rows.agg(F.max(F.size("embedding"))).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                full = np.zeros((len(batch), size))
                for i, v in enumerate(batch["embedding"]):
                    full[i, : len(v)] = v
                changed = change(full)
                yield pd.DataFrame({"vec_id": batch["vec_id"], "v": [row.tobytes() for row in changed]})

    return rows.mapInPandas(run, "vec_id long, v binary").filter(F.length("v") > 0)


def matrix(values) -> np.ndarray:
    """A column of ``v`` as rows of a matrix."""
    values = list(values)
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1) if values else np.zeros((0, 0))


def sample(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a bounded sample, drawn by the hash of the id."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "v").collect()
    return np.array([r["vec_id"] for r in drawn], np.int64), matrix(r["v"] for r in drawn)


def cells_for(count: int) -> int:
    """Cells of about ``BLOCK_ROWS`` rows, at least 64 where there are rows for it."""
    return int(max(1, min(MOST_CELLS, max(count // BLOCK_ROWS, min(64, count // 128)))))


def search(
    rows: DataFrame,
    queries: DataFrame,
    compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    score_type: str,
    k: int,
) -> DataFrame:
    """The ``k`` best results of each query, ties to the smaller id.

    ``rows`` has ``cell``, ``vec_id``, ``v``; ``queries`` the same with ``query_id`` and ``bound``, a row
    for each cell that it visits. Cells are dealt to blocks of bounded size; ``compare`` gets
    a block of rows and one of queries and returns ``query_id``, ``vec_id``, ``score``.
    """
    counts = rows.groupBy("cell").agg(F.count("*").alias("n")).collect()  # a row for each cell of the index
    parts = {r["cell"]: -(-r["n"] // BLOCK_ROWS) for r in counts}
    if not parts:
        parts = {0: 1}
    part_of = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("cell"))
    asked = queries.select("query_id").distinct().count()
    groups = max(1, -(-asked // BLOCK_QUERIES))
    dealt_rows = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), part_of)).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    dealt_queries = (
        queries.withColumn("parts", part_of)
        .filter("parts is not null")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
        .withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
        .drop("parts")
    )
    key = ["cell", "part", "group"]
    found = dealt_rows.groupBy(*key).cogroup(dealt_queries.groupBy(*key)).applyInPandas(
        compare, f"query_id long, vec_id long, score {score_type}"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def every(rows: DataFrame, step: int) -> DataFrame:
    """The stated query set: rows whose id is divisible by ``step``; of rows with one id the least vector asks."""
    return rows.filter(F.col("vec_id") % step == 0).groupBy("vec_id").agg(F.min("v").alias("v"))


