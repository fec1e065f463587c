"""Anchors that equal spans of symbols share, wherever they lie.

A span of ``span`` symbols is anchored at the least hash of its grams of ``gram``
symbols, the leftmost of equals. The choice depends on the span alone, so equal spans
have equal anchors at the same offset, and a span whose anchor's hash occurs only once
occurs only once itself. Neighbouring spans mostly share an anchor: one row stands for
a run of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols that are handled at once; longer documents go in overlapping parts.
AT_ONCE = 1 << 20
#: Bits of the place inside a part.
PLACE = np.uint64(22)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@dataclass
class Anchors:
    """Runs of spans: document, first and last start in it, hash of the anchor and of the run's content."""

    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    content: np.ndarray

    @staticmethod
    def joined(parts: list[Anchors]) -> Anchors:
        none = np.zeros(0, np.int64)
        names = ("doc", "low", "high", "anchor", "content")
        return Anchors(*(np.concatenate([getattr(p, n) for p in parts] or [none]) for n in names))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)


def byte_grams(symbols: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each place on (fewer at the end, filled with zeros)."""
    x = np.concatenate((symbols, np.zeros(16, np.uint8))).astype(np.uint64)
    for step, shift in ((1, 8), (2, 16), (4, 32)):
        x = x[:-step] | x[step:] << np.uint64(shift)
    return mix(mix(x[: len(symbols)]) + x[8 : len(symbols) + 8] * np.uint64(0xC2B2AE3D27D4EB4F))


def word_grams(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of ``gram`` word hashes from each place on."""
    padded = np.concatenate((symbols, np.zeros(gram, np.uint64)))
    total = np.zeros(len(symbols), np.uint64)
    for i in range(gram):
        total = mix(total + padded[i : len(symbols) + i])
    return total


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def find(grams, documents: list[np.ndarray], span: int, gram: int) -> Anchors:
    """The anchors of every span of each document; ``grams`` hashes an array of symbols."""
    parts, waiting, size = [], [], 0
    for doc, symbols in enumerate(documents):
        for begin in range(0, max(1, len(symbols) - span + 1), AT_ONCE):
            part = symbols[begin : begin + AT_ONCE + span - 1]
            if len(part) < span:
                continue
            waiting.append((doc, begin, part))
            size += len(part)
            if size >= AT_ONCE:
                parts.append(_anchors(grams, waiting, span, gram))
                waiting, size = [], 0
    if waiting:
        parts.append(_anchors(grams, waiting, span, gram))
    return Anchors.joined(parts)


def _anchors(grams, pieces: list[tuple[int, int, np.ndarray]], span: int, gram: int) -> Anchors:
    hashes = grams(np.concatenate([symbols for _, _, symbols in pieces]))
    size, places = len(hashes), span - gram + 1
    key = (hashes >> PLACE << PLACE) | np.arange(size, dtype=np.uint64)
    width = 1
    while 2 * width <= places:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < places:
        rest = places - width
        key = np.minimum(key[:-rest], key[rest:])
    lengths = np.array([len(symbols) for _, _, symbols in pieces])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    piece = np.repeat(np.arange(len(pieces)), lengths - span + 1)
    first = np.cumsum(lengths - span + 1) - (lengths - span + 1)
    at = np.arange(len(piece)) - first[piece] + starts[piece]
    anchor = (key[at] & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    opens = np.flatnonzero(new)
    closes = np.append(opens[1:], len(at)) - 1
    low, high, piece = at[opens], at[closes], piece[opens]
    totals = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(INVERSE, size), dtype=np.uint64)))
    content = (totals[high + places] - totals[low]) * _powers(BASE, size)[low]
    document = np.array([doc for doc, _, _ in pieces])[piece]
    shift = np.array([begin for _, begin, _ in pieces])[piece] - starts[piece]
    signed = mix(content + (high - low).astype(np.uint64)).view(np.int64)
    return Anchors(document, low + shift, high + shift, hashes[anchor[opens]].view(np.int64), signed)
