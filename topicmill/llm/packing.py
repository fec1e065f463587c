"""Harmonic packing of token documents into sequences of a fixed capacity.

A piece of ``n`` tokens belongs to the reciprocal-capacity class ``capacity // n``,
and a bin of class ``c`` takes exactly ``c`` pieces of that class. Documents are
first cut: whole sequences go alone (class 1), and a rest that would leave much
of its class's room unused gives up a piece of exactly ``capacity // (c + 1)``
tokens. Every partition fills its own bins, so nothing is shuffled; bins that are
still open when a partition ends are laid end to end and cut at the capacity, and
the last of these again at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from topicmill.llm.common import named, texts
from topicmill.llm.word_tokens import WordTokenizer, texts_of, word_tokenizer

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "piece_ids binary"
)
#: Sequences that one partition may number.
PARTITION_SEQUENCES = 1 << 36


def cut(tokens: int, capacity: int, slack: float) -> list[int]:
    """Piece lengths of a document; a piece fills all but ``slack`` of its class's share."""
    pieces = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        parts = capacity // rest
        if rest * parts >= capacity * (1 - slack):
            pieces.append(rest)
            break
        pieces.append(capacity // (parts + 1))
        rest -= pieces[-1]
    return pieces


class Bins:
    """The open bins of one partition, one for each class."""

    def __init__(self, capacity: int, first_sequence: int):
        self._capacity = capacity
        self._next = first_sequence
        self._open: dict[int, list[tuple]] = {}

    def _placed(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, self._next, offset, ids
            offset += len(ids) // 4
        self._next += 1

    def add(self, piece: tuple) -> Iterator[tuple]:
        """Yields the rows of a bin when ``piece`` completes it."""
        count = self._capacity // (len(piece[2]) // 4)
        held = self._open.setdefault(count, [])
        held.append(piece)
        if len(held) == count:
            del self._open[count]
            yield from self._placed(held)

    def close(self) -> Iterator[tuple]:
        """Lay what is left end to end; fill whole sequences, then powers of two."""
        left = [piece for count in sorted(self._open) for piece in self._open[count]]
        total, at, held = sum(len(p[2]) // 4 for p in left), 0, []
        room = self._room(total)
        while at < len(left):
            doc_id, start, ids, doc_tokens = left[at]
            size = len(ids) // 4
            taken = min(size, room)
            held.append((doc_id, start, ids[: 4 * taken], doc_tokens))
            left[at] = (doc_id, start + taken, ids[4 * taken :], doc_tokens)
            at += taken == size
            room, total = room - taken, total - taken
            if not room:
                yield from self._placed(held)
                held, room = [], self._room(total)

    def _room(self, tokens: int) -> int:
        return min(self._capacity, 1 << max(0, tokens.bit_length() - 1)) if tokens < self._capacity else self._capacity


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, slack: float = 1 / 64
) -> DataFrame:
    """Token pieces of every document with their place in a sequence.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null or empty
    text is a document of the end id alone. Repeated rows are packed each; a null
    ``doc_id`` stays null. An empty table gives no rows. Texts of any length are
    read whole. Returns the columns of ``PIECES``; ``start`` counts the ids of the
    document before the piece and ``piece_ids`` holds the ids as 32-bit integers.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tokenizer = word_tokenizer(tokenizer_path)
        bins = Bins(capacity, TaskContext.get().partitionId() * PARTITION_SEQUENCES)
        end = end_id.to_bytes(4, "little")
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc_id, ids in encoded(batch, tokenizer):
                ids += end
                tokens, start = len(ids) // 4, 0
                for length in cut(tokens, capacity, slack):
                    piece = (doc_id, start, ids[4 * start : 4 * (start + length)], tokens)
                    rows.extend(bins.add(piece))
                    start += length
                held += len(ids)
                if held > 16_000_000:
                    yield _frame(rows)
                    rows, held = [], 0
        rows.extend(bins.close())
        yield _frame(rows)

    return named(texts(docs).mapInPandas(run, PIECES))


def encoded(batch: pd.DataFrame, tokenizer: WordTokenizer) -> Iterator[tuple]:
    """Ids of a batch's texts, some hundred documents at a time."""
    for at in range(0, len(batch), 256):
        part = batch.iloc[at : at + 256]
        yield from zip(part["doc_id"], tokenizer.encode_all(texts_of(part["text"])))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [column.split()[0] for column in PIECES.split(", ")]
    return pd.DataFrame(rows, columns=names)
