"""Byte-level BPE by rank files, with a segment tree over the byte positions of a piece.

A piece's tree has one leaf for each byte position. The leaf of a live token's first
byte holds the rank of the pair it forms with the next token, together with the
position, so the root holds the leftmost pair of least rank. A merge makes the pair's
first token the merged one, takes the second out, and updates the leaves of the three
positions concerned along their paths to the root. Pieces of like size are merged
side by side in numpy; a long piece has a tree of its own.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from topicmill.llm.common import named, row_id, texts, worker_state
from topicmill.llm.word_tokens import texts_of

#: Pieces a worker remembers before it starts anew, and the longest of them in bytes.
REMEMBERED = 600_000
LONGEST = 64
#: Tree leaves that are merged side by side at once; bounds memory.
LEAVES_AT_ONCE = 1 << 21
NONE = np.iinfo(np.int64).max


class ByteBpe:
    """Encodes and decodes by a rank file and the pattern that cuts texts to pieces."""

    def __init__(self, path: str, pattern: str):
        import regex

        self._cut = regex.compile(pattern).findall
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self._pairs = pairs
        self._pair_keys = np.array(sorted(pairs), np.int64)
        self._pair_ranks = np.array([pairs[k] for k in self._pair_keys.tolist()], np.int64)
        self._byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self._known: dict[str, bytes] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of token ids; ``NONE`` where they do not merge."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        return np.where(self._pair_keys[at] == keys, self._pair_ranks[at], NONE)

    def _merge_side_by_side(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids of pieces of at most ``size`` bytes, a power of two."""
        count, shift = len(pieces), size.bit_length() - 1
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8)
        ids = self._byte_ids[raw]
        place = np.tile(np.arange(size), count)
        live = place < np.repeat(lengths, size)
        after = np.where(place + 1 < np.repeat(lengths, size), place + 1, -1)
        before = place - 1
        rank = np.full(count * size, NONE)
        first = np.flatnonzero(after >= 0)
        rank[first] = self._rank(ids[first], ids[first + 1])
        tree = np.full((count, 2 * size), NONE)
        tree[:, size:] = np.where(rank == NONE, NONE, rank << shift | place).reshape(count, size)
        width = size
        while width > 1:
            width //= 2
            tree[:, width : 2 * width] = np.minimum(
                tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2]
            )
        flat = tree.reshape(-1)
        active = np.arange(count)
        while True:
            root = flat[active * 2 * size + 1]
            busy = root != NONE
            active, root = active[busy], root[busy]
            if not len(active):
                break
            base = active * size
            i = base + (root & (size - 1))
            j = base + after[i]
            ids[i] = root >> shift
            live[j] = False
            after[i] = after[j]
            k = after[i]
            linked = k >= 0
            before[(base + k)[linked]] = (i - base)[linked]
            leaf_i = np.full(len(i), NONE)
            found = self._rank(ids[i[linked]], ids[(base + k)[linked]])
            leaf_i[linked] = np.where(found == NONE, NONE, found << shift | (i - base)[linked])
            back = before[i] >= 0
            h = (base + before[i])[back]
            found = self._rank(ids[h], ids[i[back]])
            leaf_h = np.where(found == NONE, NONE, found << shift | (h - base[back]))
            trees = np.concatenate((base, base, base[back])) * 2
            node = np.concatenate((i - base, j - base, h - base[back])) + size
            flat[trees + node] = np.concatenate((leaf_i, np.full(len(j), NONE), leaf_h))
            for _ in range(shift):
                node >>= 1
                child = trees + 2 * node
                flat[trees + node] = np.minimum(flat[child], flat[child + 1])
        alive = np.flatnonzero(live)
        tokens = ids[alive].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(alive // size, minlength=count))
        return [tokens[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _merge_long(self, piece: bytes) -> bytes:
        """Ids of one long piece, with its tree in flat 64-bit arrays."""
        length = len(piece)
        shift = max(1, (length - 1).bit_length())
        size, rank_of, none = 1 << shift, self._pairs.get, int(NONE)
        ids = array("q", self._byte_ids[np.frombuffer(piece, np.uint8)].tobytes())
        after = array("q", [*range(1, length), -1])
        before = array("q", range(-1, length - 1))
        start = np.full(2 * size, NONE)
        known = np.frombuffer(ids, np.int64)
        found = self._rank(known[:-1], known[1:])
        start[size : size + length - 1] = np.where(found == NONE, NONE, found << shift | np.arange(length - 1))
        width = size
        while width > 1:
            width //= 2
            start[width : 2 * width] = np.minimum(start[2 * width : 4 * width : 2], start[2 * width + 1 : 4 * width : 2])
        tree = array("q", start.tobytes())
        live = bytearray(b"\1") * length
        while tree[1] != none:
            i = tree[1] & (size - 1)
            j = after[i]
            ids[i] = tree[1] >> shift
            live[j] = 0
            k = after[i] = after[j]
            changed = [(j, None)]
            if k >= 0:
                before[k] = i
                changed.append((i, rank_of(ids[i] << 32 | ids[k])))
            else:
                changed.append((i, None))
            if (h := before[i]) >= 0:
                changed.append((h, rank_of(ids[h] << 32 | ids[i])))
            for place, rank in changed:
                node = size + place
                tree[node] = none if rank is None else rank << shift | place
                while node > 1:
                    node >>= 1
                    tree[node] = min(tree[2 * node], tree[2 * node + 1])
        kept = np.frombuffer(live, np.uint8).astype(bool)
        return np.frombuffer(ids, np.int64)[kept].astype("<u4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each non-empty piece as little-endian 32-bit integers."""
        found: list[bytes] = [b""] * len(pieces)
        sizes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[i] = whole.to_bytes(4, "little")
            elif len(piece) > 4 * LONGEST:
                found[i] = self._merge_long(piece)
            else:
                sizes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
        for size, members in sizes.items():
            step = max(1, LEAVES_AT_ONCE // size)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._merge_side_by_side([pieces[i] for i in part], size)):
                    found[i] = ids
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; a null text has none."""
        cut = [self._cut(text) if text else [] for text in texts]
        pieces = set().union(*cut)
        new = pieces.difference(self._known)
        if len(self._known) + len(new) > REMEMBERED:
            self._known, new = {}, pieces
        names = list(new)
        self._known.update(zip(names, self.merge([n.encode("utf-8", "surrogatepass") for n in names])))
        encoded = [b"".join(map(self._known.__getitem__, part)) for part in cut]
        for name in names:
            if len(name) > LONGEST:
                del self._known[name]
        return encoded

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _coder(path: str, pattern: str) -> ByteBpe:
    return worker_state(("byte bpe", path, pattern), lambda: ByteBpe(path, pattern))


def _encoded(batch: pd.DataFrame, coder: ByteBpe) -> Iterator[tuple]:
    for at in range(0, len(batch), 256):
        part = batch.iloc[at : at + 256]
        for doc_id, ids in zip(part["doc_id"], coder.encode_all(texts_of(part["text"]))):
            yield doc_id, np.frombuffer(ids, "<u4").tolist()


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids``: the token ids of each whole text.

    A null text counts as empty and has no ids. Repeated rows are encoded each, a null
    ``doc_id`` stays null, other columns are ignored. One pass without a shuffle.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _coder(path, pattern)
        for batch in batches:
            ids = [ids for _, ids in _encoded(batch, coder)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids})

    return named(texts(docs).mapInPandas(run, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``bytes``: the bytes that ``ids`` stand for; null ids give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _coder(path, pattern)
        for batch in batches:
            decoded = [coder.decode([] if ids is None else list(ids)) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "bytes": decoded})

    source = encoded.select(row_id().alias("doc_id"), "ids")
    return named(source.mapInPandas(run, "doc_id long, bytes binary"))


ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode each text in one pass and keep digests of both results.

    Rows as those of ``encode``; the digests are of the decimal ids joined by commas
    and of the decoded bytes, in lower-case hex.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _coder(path, pattern)
        decimal = worker_state(("decimal ids", path), dict)
        if not decimal:
            decimal.update((i, b"%d" % i) for i in coder.bytes_of)
        for batch in batches:
            rows = []
            for doc_id, ids in _encoded(batch, coder):
                named = hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest()
                rows.append((doc_id, len(ids), named, hashlib.sha256(coder.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return named(texts(docs).mapInPandas(run, ROUND_TRIP))
