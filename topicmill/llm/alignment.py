"""Alignment of two tokenizers' tokens over the same bytes.

Both end lists of a text are sorted, and a token of either side ends a group where both
lists hold the same offset. The shorter list drives: each of its ends is looked for in the
longer one by steps that double from the last place and a binary search in the last step.
Common indices slice the tokens into groups, and the differences of their ranks are the
groups' token numbers. Runs of the driving list are searched side by side in numpy.

Every token of a group is linked to every token of the other side. A pair of ids counts
once for each document that links it. Counts of the most frequent pairs, a bounded number,
go to all tasks; documents meet the counts of their other pairs by a shuffle on the pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.llm.byte_tokens import byte_tokenizer
from topicmill.llm.common import Sent, named, texts, worker_state, written

#: Ends of the driving list that are looked for one after another; such runs go side by side.
RUN = 64
#: Characters, and links, that a task works on at once.
CHARACTERS_AT_ONCE, LINKS_AT_ONCE = 500_000, 1_000_000
#: Most pairs whose counts are sent to all tasks, and pairs that a task adds up before it gives them on.
FREQUENT_PAIRS = 500_000
HELD_PAIRS = 500_000

GROUPS = "key long, doc_id long, a_ids binary, b_ids binary, a_last binary, b_last binary"
DIGESTS = (
    "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, rare_pairs array<long>, rare_links array<long>"
)


def gallop(x: np.ndarray, y: np.ndarray, run: int = RUN) -> np.ndarray:
    """The first place in ``y`` whose value is not below each value of ``x``; both ascend.

    Each run of ``x`` starts at a binary search for its first value and then goes on from
    place to place.
    """
    places = np.empty(len(x), np.int64)
    if not len(x):
        return places
    last = len(y)
    end = np.append(y, np.iinfo(np.int64).max)  # beyond all values
    heads = np.arange(0, len(x), run)
    at = np.searchsorted(y, x[heads])
    for step in range(run):
        if heads[-1] + step >= len(x):  # only the last run is shorter
            heads, at = heads[:-1], at[:-1]
            if not len(heads):
                break
        mine = heads + step
        wanted = x[mine]
        behind = np.flatnonzero(end[at] < wanted)
        if len(behind):
            low, goal = at[behind], wanted[behind]  # end[low] < goal
            size = np.ones(len(behind), np.int64)
            busy = np.arange(len(behind))
            while len(busy):  # double the step while it stays below
                ahead = np.minimum(low[busy] + size[busy], last)
                below = end[ahead] < goal[busy]
                busy = busy[below]
                low[busy] = ahead[below]
                size[busy] *= 2
            high = np.minimum(low + size, last)  # end[high] >= goal
            busy = np.flatnonzero(high - low > 1)
            while len(busy):
                middle = (low[busy] + high[busy]) // 2
                below = end[middle] < goal[busy]
                low[busy[below]] = middle[below]
                high[busy[~below]] = middle[~below]
                busy = busy[high[busy] - low[busy] > 1]
            at[behind] = high
        places[mine] = at
    return places


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, a_of: np.ndarray, b_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of equal ends in two lists that ascend over several texts.

    ``a_of`` and ``b_of`` are the first index of each text, and the length at the end; in
    each text the shorter list drives.
    """
    a_drives = np.diff(a_of) <= np.diff(b_of)
    found = []
    for drives, x, x_of, y, y_of in ((a_drives, a_ends, a_of, b_ends, b_of), (~a_drives, b_ends, b_of, a_ends, a_of)):
        xs = np.flatnonzero(np.repeat(drives, np.diff(x_of)))
        ys = np.flatnonzero(np.repeat(drives, np.diff(y_of)))
        places = gallop(x[xs], y[ys])
        hit = np.flatnonzero(places < len(ys))
        hit = hit[y[ys[places[hit]]] == x[xs[hit]]]
        found.append((xs[hit], ys[places[hit]]))
    a_at = np.concatenate([found[0][0], found[1][1]])
    b_at = np.concatenate([found[0][1], found[1][0]])
    order = np.argsort(a_at)
    return a_at[order], b_at[order]


class PieceTokenizer:
    """A ``sentencepiece`` model; ``pieces`` and ``sizes`` are the bytes of each id and their number."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        byte = [self._model.is_byte(i) for i in range(len(names))]
        self.pieces = [
            bytes([int(n[3:5], 16)]) if b else n.replace("▁", " ").encode() for n, b in zip(names, byte)
        ]
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)

    def encode_all(self, found: list[str]) -> list[list[int]]:
        return self._model.encode(found, num_threads=1) if found else []


class Aligner:
    """Both tokenizers of a worker. A is given a space before the text, which B adds by itself."""

    def __init__(self, a_path: str, pattern: str, b_path: str):
        self.a = byte_tokenizer(a_path, pattern, plain=True)
        self.b = PieceTokenizer(b_path)

    def groups(self, found: list[str | None]) -> list[tuple[bytes, bytes, bytes, bytes]]:
        """The last four columns of ``GROUPS`` of each text."""
        tokens = []
        b_all = iter(self.b.encode_all([t for t in found if t]))
        for text in found:
            a_ids = b_ids = np.zeros(0, np.int64)
            if text:
                whole = f" {text}".encode()
                a_ids, b_ids = self.a.encode(f" {text}").astype(np.int64), np.array(next(b_all), np.int64)
                if self._bytes(self.a, a_ids) != whole or self._bytes(self.b, b_ids) != whole:
                    a_ids = b_ids = a_ids[:0]
            tokens.append((a_ids, b_ids))
        a_ids, b_ids = (np.concatenate([t[i] for t in tokens]) for i in (0, 1))
        a_of, b_of = (np.cumsum([0, *[len(t[i]) for t in tokens]]) for i in (0, 1))
        a_at, b_at = common_ends(np.cumsum(self.a.sizes[a_ids]), np.cumsum(self.b.sizes[b_ids]), a_of, b_of)
        a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        a_last[a_at], b_last[b_at] = True, True
        a_kind, b_kind = number_type(len(self.a.pieces)), number_type(len(self.b.pieces))
        return [
            (a.astype(a_kind).tobytes(), b.astype(b_kind).tobytes(), bits(a_last[i:j]), bits(b_last[k:m]))
            for (a, b), i, j, k, m in zip(tokens, a_of[:-1], a_of[1:], b_of[:-1], b_of[1:])
        ]

    @staticmethod
    def _bytes(tokenizer, ids: np.ndarray) -> bytes:
        return b"".join(map(tokenizer.pieces.__getitem__, ids.tolist()))


def number_type(ids: int) -> str:
    """How ids below ``ids`` are written: 16 or 32 bits, lowest byte first."""
    return "<u2" if ids <= 1 << 16 else "<u4"


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags, bitorder="little").tobytes()


def _numbers(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of some binary values, and the first index of each value."""
    of = np.cumsum([0, *map(len, column)]) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column), kind).astype(np.int64), of


def _set_bits(column, of: np.ndarray) -> np.ndarray:
    """The places of the bits that are set, in flags packed value by value."""
    flags = np.unpackbits(np.frombuffer(b"".join(column), np.uint8), bitorder="little")
    first = 8 * np.cumsum([0, *map(len, column)])[:-1]
    sizes = np.diff(of)
    return np.flatnonzero(flags[np.repeat(first - of[:-1], sizes) + np.arange(of[-1])])


def aligned(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """``GROUPS``: the ids of both tokenizers, and which of them end a group.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. ``key`` tells rows apart. Ids are
    written as ``number_type`` says, ``a_last`` and ``b_last`` are a bit for each token, the lowest
    first; a group is what lies between two set bits, on both sides alike. Texts that are null or empty,
    or whose tokens' bytes are not those of a space and the text, have no tokens. Repeated rows
    are rows of their own; a null ``doc_id`` is ``NO_ID`` here. Texts of any length are read whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        aligner = worker_state(("aligner", a_path, pattern, b_path), lambda: Aligner(a_path, pattern, b_path))
        key = TaskContext.get().partitionId() << 38
        names = [column.split()[0] for column in GROUPS.split(", ")]
        for batch in batches:
            sizes = np.array([len(t) if isinstance(t, str) else 0 for t in batch["text"]], np.int64)
            for first, after in slices(sizes, CHARACTERS_AT_ONCE):
                part = batch.iloc[first:after]
                found = aligner.groups([t if isinstance(t, str) else None for t in part["text"]])
                yield pd.DataFrame(
                    [(key + n, doc_id, *four) for n, (doc_id, four) in enumerate(zip(part["doc_id"], found))], columns=names
                )
                key += len(part)

    return texts(docs).mapInPandas(run, GROUPS)


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows, each of one row or a total size of at most ``most``."""
    total, first = np.cumsum(sizes), 0
    while first < len(sizes):
        before = total[first] - sizes[first]
        after = max(first + 1, int(np.searchsorted(total, before + most, side="right")))
        yield first, after
        first = after


class Part:
    """Some rows of ``GROUPS`` as flat arrays; ``a_size`` and ``width`` are the numbers of ids."""

    def __init__(self, rows: pd.DataFrame, a_size: int, width: int):
        self.rows, self.width, self.span = rows, width, a_size * width
        self.a_ids, self.a_of = _numbers(rows["a_ids"], number_type(a_size))
        self.b_ids, self.b_of = _numbers(rows["b_ids"], number_type(width))
        a_at, b_at = _set_bits(rows["a_last"], self.a_of), _set_bits(rows["b_last"], self.b_of)
        self.a_counts, self.b_counts = np.diff(a_at, prepend=-1), np.diff(b_at, prepend=-1)
        self.of = np.searchsorted(a_at, self.a_of)  # every text with tokens ends with a group
        self.a_first, self.b_first = a_at + 1 - self.a_counts, b_at + 1 - self.b_counts
        self.doc = np.repeat(np.arange(len(rows)), np.diff(self.of))
        self.links = self.a_counts * self.b_counts

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, pair and number of links of each pair that a row links, by row and pair."""
        found = []
        for first, after in slices(self.links, LINKS_AT_ONCE):
            a, b, links = self._of_groups(first, after) if after > first + 1 else self._of_group(first)
            doc = np.repeat(self.doc[first:after], self.links[first:after]) if after > first + 1 else self.doc[first]
            found.append(_summed(doc * self.span + a * self.width + b, links))
        keys, links = (np.concatenate(column) for column in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        keys, links = _summed(keys, links) if len(found) > 1 else (keys, links)
        return keys // self.span, keys % self.span, links

    def _of_groups(self, first: int, after: int):
        links = self.links[first:after]
        group = np.repeat(np.arange(first, after), links)
        place = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
        down, across = np.divmod(place, self.b_counts[group])
        a, b = self.a_ids[self.a_first[group] + down], self.b_ids[self.b_first[group] + across]
        return a, b, None

    def _of_group(self, group: int):
        """One group, which may be long: its different ids, paired, with the product of their numbers."""
        a, a_n = np.unique(self.a_ids[self.a_first[group] :][: self.a_counts[group]], return_counts=True)
        b, b_n = np.unique(self.b_ids[self.b_first[group] :][: self.b_counts[group]], return_counts=True)
        return np.repeat(a, len(b)), np.tile(b, len(a)), np.outer(a_n, b_n).ravel()

    def written_groups(self, table: list[str], a_size: int) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of each row; ``table`` has every id with what may follow it."""
        a_last, b_last = (np.zeros(len(ids), bool) for ids in (self.a_ids, self.b_ids))
        a_last[self.a_first + self.a_counts - 1] = True
        b_last[self.b_first + self.b_counts - 1] = True
        b_code = 2 * a_size + self.b_ids + self.width * b_last
        ends = self.b_of[1:][np.diff(self.b_of) > 0] - 1
        b_code[ends] += self.width
        code = np.empty(len(a_last) + len(b_last), np.int64)
        code[np.arange(len(a_last)) + np.repeat(self.b_first, self.a_counts)] = self.a_ids + a_size * a_last
        code[np.arange(len(b_last)) + np.repeat(self.a_first + self.a_counts, self.b_counts)] = b_code
        look, of = table.__getitem__, self.a_of + self.b_of
        for i, j in zip(of[:-1], of[1:]):
            yield "".join(map(look, code[i:j].tolist()))


def _summed(keys: np.ndarray, numbers: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its numbers; without numbers each counts one."""
    if numbers is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[new], np.add.reduceat(numbers[order], new) if len(new) else numbers[:0]


def _parts(batches: Iterator[pd.DataFrame], a_size: int, width: int) -> Iterator[Part]:
    for batch in batches:
        sizes = np.array([len(a) + len(b) for a, b in zip(batch["a_ids"], batch["b_ids"])], np.int64)
        for first, after in slices(sizes, 2 * CHARACTERS_AT_ONCE):
            yield Part(batch.iloc[first:after], a_size, width)


def pair_counts(groups: DataFrame, a_size: int, width: int) -> DataFrame:
    """``(pair, docs)``: the rows that link each pair of ids ``pair // width`` and ``pair % width``.

    Tasks add up what they hold before it is shuffled, so a pair of every document
    costs a row a task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in _parts(batches, a_size, width):
            new, n = np.unique(part.pairs()[1], return_counts=True)
            pairs, docs = _summed(np.concatenate([pairs, new]), np.concatenate([docs, n]))
            if len(pairs) > HELD_PAIRS:
                yield pd.DataFrame({"pair": pairs, "docs": docs})
                pairs, docs = pairs[:0], docs[:0]
        yield pd.DataFrame({"pair": pairs, "docs": docs})

    parts = groups.drop("key", "doc_id").mapInPandas(run, "pair long, docs long")
    return parts.groupBy("pair").agg(F.sum("docs").alias("docs"))


def frequent_pairs(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the pairs: all that at least a certain number of documents link.

    The number is told by a histogram whose classes grow by a sixteenth.
    """
    size = F.floor(16 * F.log2("docs")).alias("size")
    classes = sorted((r["size"], r["n"]) for r in counts.groupBy(size).agg(F.count("*").alias("n")).collect())
    taken, least = 0, None
    for kind, n in reversed(classes):
        taken += n
        if taken > most:
            break
        least = kind
    return counts.filter("false") if least is None else counts.filter(size >= least)


def scored(groups: DataFrame, a_size: int, width: int) -> DataFrame:
    """``DIGESTS`` without its last two columns, for written ``GROUPS``.

    A pair's count is the number of rows that link it; ``n_best`` counts links whose pair
    has the highest count of its id of A, ties included. What reaches the driver is a row for
    each id of A, and ``FREQUENT_PAIRS`` pairs at most.
    """
    spark = groups.sparkSession
    counts = written(pair_counts(groups, a_size, width), "pair-counts")
    a_id = F.expr(f"pair DIV {width}")
    best = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("best"))
    known = frequent_pairs(counts, FREQUENT_PAIRS).toPandas().sort_values("pair")
    highest = np.zeros(a_size, np.int64)
    for row in best.toPandas().itertuples():
        highest[row.a] = row.best
    sent = Sent(spark, (known["pair"].to_numpy(np.int64), known["docs"].to_numpy(np.int64), highest))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, docs, most = sent.value
        table = worker_state(("numbers", a_size, width), lambda: _written_numbers(a_size, width))
        for part in _parts(batches, a_size, width):
            row, pair, links = part.pairs()
            at = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
            count = np.where(hit, docs[at] if len(pairs) else 0, 0)
            top = hit & (count == most[pair // width])
            size = len(part.rows)
            rare = np.flatnonzero(~hit)
            of = np.searchsorted(row[rare], np.arange(size + 1))
            joined = list(part.written_groups(table, a_size))
            yield pd.DataFrame(
                {
                    "key": part.rows["key"].to_numpy(),
                    "doc_id": part.rows["doc_id"].to_numpy(),
                    "n_a": np.diff(part.a_of),
                    "n_b": np.diff(part.b_of),
                    "n_groups": np.diff(part.of),
                    "n_links": _by_row(row, links, size),
                    "n_best": _by_row(row, links * top, size),
                    "count_sum": _by_row(row, links * count, size),
                    "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in joined],
                    "rare_pairs": [pair[rare[i:j]] for i, j in zip(of[:-1], of[1:])],
                    "rare_links": [links[rare[i:j]] for i, j in zip(of[:-1], of[1:])],
                }
            )

    found = written(groups.mapInPandas(run, DIGESTS), "digests")
    rare = found.select("key", F.inline(F.arrays_zip(F.col("rare_pairs").alias("pair"), F.col("rare_links").alias("links"))))
    # one row for each id of A, so its size is bounded by the tokenizer
    measured = rare.join(counts, "pair").withColumn("a", a_id).join(F.broadcast(best), "a")
    link = F.when(F.col("docs") == F.col("best"), F.col("links"))
    more = measured.groupBy("key").agg(
        F.sum(F.col("links") * F.col("docs")).alias("more_sum"), F.coalesce(F.sum(link), F.lit(0)).alias("more_best")
    )
    none = F.lit(0)
    return (
        found.drop("rare_pairs", "rare_links")
        .join(more, "key", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", none))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", none))
        .drop("more_sum", "more_best")
    )


def _by_row(row: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(size, np.int64)
    np.add.at(total, row, numbers)
    return total


def _written_numbers(a_size: int, b_size: int) -> list[str]:
    a, b = [str(i) for i in range(a_size)], [str(i) for i in range(b_size)]
    return [i + "," for i in a] + [i + "|" for i in a] + [i + "," for i in b] + [i + ";" for i in b] + b


def digests(docs: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """A row for each document: its tokens, groups, links, counts and a hash of its groups.

    Null and empty texts, and texts that a tokenizer changes, have zeros and an empty hash;
    an empty table gives no rows. See ``aligned`` for the other cases.
    """
    groups = written(aligned(docs, a_path, pattern, b_path), "groups")
    aligner = Aligner(a_path, pattern, b_path)
    return named(scored(groups, len(aligner.a.pieces), len(aligner.b.pieces)).drop("key"))
