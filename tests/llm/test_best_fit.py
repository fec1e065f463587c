"""Best-fit packing: every id in its place, counts certified by bounds that no packing beats."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from cases import documents, rows
from tokenizers import Tokenizer

from topicmill.llm import best_fit

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def checked(found, texts, capacity):
    """The pieces tell every document's ids in order and lie gapless in their sequences."""
    tokenizer = Tokenizer.from_file(PATH)
    by_row, sequences = {}, {}
    for r in sorted(found, key=lambda r: r["key"]):
        ids = np.frombuffer(r["piece_ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["piece_ids"]) == r["ids_crc32"]
        if r["piece"] == 0:
            by_row[r["key"]] = (r["doc_id"], [])
            last = r["key"]
        parts = by_row[last][1]
        assert (r["piece"], r["start"]) == (len(parts), sum(map(len, parts))) and r["doc_id"] == by_row[last][0]
        assert r["length"] == capacity or r["piece"] == 0
        parts.append(ids)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    got = sorted(((i is None, i or 0), np.concatenate(p).tolist()) for i, p in by_row.values())
    want = sorted(((i is None, i or 0), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in texts)
    assert got == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark):
    texts = rows() + [(400, "x" * 5000), (401, " " * 3000 + "end"), (402, "a <|endoftext|> b")]
    for capacity in (1024, 64):
        packed = best_fit.pack(documents(spark, texts), PATH, PATTERN, capacity)
        assert "open" not in packed.columns
        count = checked(packed.collect(), texts, capacity)
        sequences, bound = best_fit.certificate(packed, capacity)
        assert sequences == count and bound <= count <= bound + 2
    assert best_fit.pack(documents(spark, []), PATH, PATTERN).count() == 0


def test_exchange_between_unlike_partitions(spark, monkeypatch):
    """One task holds pieces above half a sequence, another the ones that fill their gaps."""
    monkeypatch.setattr(best_fit, "EXCHANGED_PIECES", 150)
    long, short = [(i, "the " * 36) for i in range(200)], [(1000 + i, "the " * 23) for i in range(200)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(long + short, 2), "doc_id long, text string")
    apart = best_fit._first_pools(docs, PATH, PATTERN, 64, 2)
    alone = best_fit.certificate(apart, 64)
    packed = best_fit.pack(docs, PATH, PATTERN, 64)
    checked(packed.collect(), long + short, 64)
    together = best_fit.certificate(packed, 64)
    assert alone == (200 + 100, 200) and together[1] == 200 and together[0] <= 204  # pools are dealt by a hash
    pools = packed.select("pool", "pool_sequences", "pool_bound").distinct().collect()
    assert len(pools) > 1 and all(p["pool_sequences"] >= p["pool_bound"] for p in pools)


def least_bins(lengths, capacity):
    for bins in itertools.count(0):
        rooms = [capacity] * bins

        def fits(at):
            if at == len(lengths):
                return True
            tried = set()
            for i in range(bins):
                if rooms[i] >= lengths[at] and rooms[i] not in tried:
                    tried.add(rooms[i])
                    rooms[i] -= lengths[at]
                    if fits(at + 1):
                        return True
                    rooms[i] += lengths[at]
            return False

        if fits(0):
            return bins


def test_bounds_and_best_fit():
    rng, certified = random.Random(4), 0
    for _ in range(200):
        capacity = rng.choice([10, 17, 30])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 9))), reverse=True)
        values, counts = np.unique(lengths, return_counts=True)
        bound, least = best_fit.lower_bound(values, counts, capacity), least_bins(lengths, capacity)
        bins, places, left = best_fit.best_fit(np.array(lengths, np.int64), capacity)
        assert bound <= least <= len(left)
        certified += bound == len(left)
        for b in range(len(left)):
            inside = sorted((p, n) for p, n, i in zip(places, lengths, bins) if i == b)
            assert [p for p, _ in inside] == list(itertools.accumulate([n for _, n in inside], initial=0))[:-1]
            assert capacity - sum(n for _, n in inside) == left[b] >= 0
    assert certified > 150
    half = np.array([6], np.int64)
    assert best_fit.lower_bound(half, np.array([7]), 10) == 7  # not the 5 that their sum needs
