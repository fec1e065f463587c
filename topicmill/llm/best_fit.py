"""Best-fit packing whose sequence counts are certified by lower bounds.

A document that is longer than a sequence gives whole sequences and one rest. Each task
encodes its documents and packs their rests pool by pool, best fit decreasing. Dual-feasible
functions (Fekete and Schepers 2001; Carlier, Clautiaux and Moukrim 2007) bound from below
the bins that the lengths of a pool need, which certifies its count. What lies in bins with a
gap is then exchanged: a hash deals these pieces, by key and length alone, to new pools of a
bounded size, which are packed again, until the bound over all of them is met or a round saves
nothing. The ids of a document are written once and only joined to a new place at the end.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.llm.byte_tokens import byte_tokenizer
from topicmill.llm.common import named, texts, written

#: Pieces of a pool while their ids are held, and of a pool of exchanged pieces.
POOL_PIECES = 16_384
EXCHANGED_PIECES = 131_072
#: Most rounds of exchange; each but the last saves at least one sequence.
MOST_ROUNDS = 12
#: Parameters tried of each family of dual-feasible functions.
PARAMETERS = 256
_HELD_BYTES = 16_000_000
_PARTITION_KEYS = 1 << 38

PLACE = "sequence_id long, offset long, pool long, pool_sequences long, pool_bound long, open boolean"
PIECES = f"key long, doc_id long, piece int, start long, length long, ids_crc32 long, {PLACE}, piece_ids binary"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin and the place in it of each length, and the room left in each bin.

    Longest first, ties in the given order; each goes to the fullest bin that it fits,
    of several to the one that was filled last. Bins are found by the bits of their rooms.
    """
    order = np.argsort(-lengths, kind="stable")
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, left = 0, []
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for at, n in zip(order.tolist(), lengths[order].tolist()):
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            found = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, found = capacity, len(left)
            left.append(capacity)
        bins[at], places[at] = found, capacity - room
        left[found] = room = room - n
        if room:
            with_room[room].append(found)
            rooms |= 1 << room
    return bins, places, np.array(left, np.int64)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces of these lengths need at least, by dual-feasible functions.

    Each function weighs lengths so that no full bin weighs more than ``full``; all numbers
    are whole, so the quotient is rounded up without error.
    """
    if not len(lengths):
        return 0
    x, counts = np.asarray(lengths, np.int64), np.asarray(counts).astype(object)  # large sums stay whole

    def bins(weights: np.ndarray, full: int) -> int:
        return -(-int((weights.astype(object) * counts).sum()) // full)

    best = bins(x, capacity)
    for cut in np.unique(np.linspace(1, capacity // 2, PARAMETERS).astype(np.int64)).tolist() if capacity > 1 else []:
        long = np.where(x > capacity - cut, capacity, np.where(x < cut, 0, x))
        steps = np.where(2 * x > capacity, 2 * (capacity // cut - (capacity - x) // cut), 2 * (x // cut))
        steps = np.where(2 * x == capacity, capacity // cut, steps)
        best = max(best, bins(long, capacity), bins(steps, 2 * (capacity // cut)))
    for k in range(1, 33):
        even = (k + 1) * x % capacity == 0
        best = max(best, bins(np.where(even, k * x, (k + 1) * x // capacity * capacity), k * capacity))
    return best


def _packed(keys: np.ndarray, lengths: np.ndarray, capacity: int, pool: int) -> pd.DataFrame:
    """The ``PLACE`` of each piece of a pool. A sequence is named by its first piece.

    Open are the pieces in bins with a gap; when the gaps of all bins together are less than
    a bin, only those in the emptiest.
    """
    bins, places, left = best_fit(lengths, capacity)
    first = np.empty(len(left), np.int64)
    first[bins[places == 0]] = keys[places == 0]
    values, counts = np.unique(lengths, return_counts=True)
    gap = left > 0
    if left.sum() < capacity:
        gap &= np.arange(len(left)) == (left.argmax() if len(left) else 0)
    return pd.DataFrame(
        {
            "sequence_id": first[bins],
            "offset": places,
            "pool": pool,
            "pool_sequences": len(left),
            "pool_bound": lower_bound(values, counts, capacity),
            "open": gap[bins],
        }
    )


def _first_pools(docs: DataFrame, path: str, pattern: str, capacity: int, end_id: int) -> DataFrame:
    """``PIECES`` of all documents, packed by the tasks that encode them."""
    names = [column.split()[0] for column in PIECES.split(", ")]
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tokenizer = byte_tokenizer(path, pattern)
        key = TaskContext.get().partitionId() * _PARTITION_KEYS
        whole, rests, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([tokenizer.encode(text if isinstance(text, str) else None), end])
                rest = len(ids) % capacity
                cuts = [0] * (rest > 0) + list(range(rest, len(ids), capacity))
                for piece, (start, stop) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
                    part = ids[start:stop].tobytes()
                    row = (key, doc_id, piece, start, stop - start, zlib.crc32(part))
                    if stop - start == capacity:
                        whole.append((*row, key, 0, None, None, None, False, part))
                        held += len(part)
                    else:
                        rests.append((*row, part))
                    key += 1
                    if held > _HELD_BYTES:
                        yield frame(whole)
                        whole, held = [], 0
                if len(rests) == POOL_PIECES:
                    yield from pool(rests)
                    rests = []
        yield frame(whole)
        yield from pool(rests)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=names)
        return found.astype({n: "Int64" for n in ("pool", "pool_sequences", "pool_bound")})

    def pool(rests: list[tuple]) -> Iterator[pd.DataFrame]:
        if rests:
            found = pd.DataFrame(rests, columns=[*names[:6], "piece_ids"])
            places = _packed(found["key"].to_numpy(), found["length"].to_numpy(), capacity, rests[0][0])
            yield pd.concat([found, places], axis=1)[names]

    return texts(docs).mapInPandas(run, PIECES)


def _exchanged(pieces: DataFrame, pools: int, turn: int, capacity: int) -> DataFrame:
    """``(key, length)`` and the new ``PLACE`` of pieces dealt anew to ``pools``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", ignore_index=True)
        keys, lengths = group["key"].to_numpy(), group["length"].to_numpy()
        return pd.concat([group[["key", "length"]], _packed(keys, lengths, capacity, int(keys[0]))], axis=1)

    dealt = pieces.select("key", "length", F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(pools)).alias("dealt"))
    return dealt.groupBy("dealt").applyInPandas(run, f"key long, length long, {PLACE}")


def _tally(pieces: DataFrame, capacity: int) -> tuple[int, int, int]:
    """Pieces, sequences and the bound of sequences; a row for each length reaches the driver."""
    first = F.count_if(F.col("offset") == 0)
    rows = pieces.groupBy("length").agg(F.count("*").alias("n"), first.alias("first")).collect()
    lengths, counts = np.array([r["length"] for r in rows]), np.array([r["n"] for r in rows])
    return int(counts.sum()), sum(r["first"] for r in rows), lower_bound(lengths, counts, capacity)


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Token pieces of every document with their place in a sequence.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null or empty text is a
    document of the end id alone. Repeated rows are packed each; a null ``doc_id`` stays null. An
    empty table gives no rows. Texts of any length are read whole. Returns the columns of
    ``PIECES`` but ``open``; the first piece of a long document is the short one. ``key`` tells
    pieces apart, ``piece_ids`` holds the ids as 32-bit integers, and ``pool_bound`` is the
    least number of sequences for the pool that was packed into ``pool_sequences`` (both null
    for a piece that fills a sequence).
    """
    pieces = written(_first_pools(docs, tokenizer_path, pattern, capacity, end_id), "pieces")
    place = [column.split()[0] for column in PLACE.split(", ")]
    now = pieces.filter("open").select("key", "length", *place)
    settled = []
    for turn in range(MOST_ROUNDS):
        n, sequences, bound = _tally(now, capacity)
        if sequences <= bound:
            break
        pools = math.ceil(n / EXCHANGED_PIECES)
        after = written(_exchanged(now, pools, turn, capacity), "exchanged")
        if _tally(after, capacity)[1] >= sequences:
            break
        settled.append(after.filter("NOT open"))
        now = after.filter("open")
        if pools == 1:
            break
    if settled:
        placed = reduce(DataFrame.unionByName, [*settled, now]).drop("length")
        moved = pieces.filter("open").drop(*place).join(placed, "key")
        pieces = pieces.filter("NOT open").unionByName(moved)
    return named(pieces.drop("open"))


def certificate(pieces: DataFrame, capacity: int = 1024) -> tuple[int, int]:
    """The sequences of packed pieces, and how many any packing of them needs at least."""
    return _tally(pieces, capacity)[1:]
