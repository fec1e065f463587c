"""Token alignment against a walk along both token lists, one token at a time."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import documents, rows
from tokenizers import Tokenizer

from topicmill.llm import alignment
from topicmill.llm.byte_tokens import byte_alphabet, byte_tokenizer

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


def odd_texts(count):
    rng = random.Random(1)
    parts = ["a", "B", "é", "日", " ", " ", "  ", "\n", "\t", "\r", "1", "23", ".", ",", "'s", "'ll", "<|endoftext|>", "<|", "|>"]
    parts += ["\xa0", "\x85", "\x1c", "😀", "́", "​", "▁", "\x00", "the", "ing", "ﬁ", "①"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(count)]


@pytest.mark.parametrize("plain", [False, True])
def test_ids_of_the_file(plain):
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = plain
    mine = byte_tokenizer(A_PATH, PATTERN, plain)
    texts = odd_texts(5000) + ["x" * 20_000, " " * 20_000 + "a", "ab" * 20_000]
    for text, encoded in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = mine.encode(text).tolist()
        assert ids == encoded.ids
        assert b"".join(mine.pieces[i] for i in ids) == text.encode()


def walked(text, library, model):
    a = library.encode(f" {text}", add_special_tokens=False).ids
    b = model.encode(text)
    letters = byte_alphabet()
    a_bytes = [bytes(letters[c] for c in library.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    groups, whole = [], f" {text}".encode()
    if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return groups
    i = j = at_a = at_b = 0
    mine, other = [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            at_a += len(a_bytes[i])
            mine.append(a[i])
            i += 1
        else:
            at_b += len(b_bytes[j])
            other.append(b[j])
            j += 1
        if at_a == at_b:
            groups.append((mine, other))
            mine, other = [], []
    return groups


def expected(texts):
    library, model = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    library.encode_special_tokens = True
    groups = [walked(t or "", library, model) for t in texts]
    links = [Counter((x, y) for mine, other in g for x in mine for y in other) for g in groups]
    count = Counter(pair for found in links for pair in found)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for g, found in zip(groups, links):
        text = ";".join(",".join(map(str, mine)) + "|" + ",".join(map(str, other)) for mine, other in g)
        yield (
            sum(len(mine) for mine, _ in g),
            sum(len(other) for _, other in g),
            len(g),
            found.total(),
            sum(n for pair, n in found.items() if count[pair] == best[pair[0]]),
            sum(n * count[pair] for pair, n in found.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        )


@pytest.mark.parametrize("frequent, at_once", [(500_000, 4_000_000), (20, 50), (0, 4_000_000)])
def test_digests(spark, monkeypatch, frequent, at_once):
    monkeypatch.setattr(alignment, "FREQUENT_PAIRS", frequent)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", at_once)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 100)
    found = rows() + [(1000 + i, t) for i, t in enumerate(odd_texts(60))] + [(2000, "same words here")] * 40
    got = [tuple(r) for r in alignment.digests(documents(spark, found), A_PATH, PATTERN, B_PATH).collect()]
    want = [(i, *row) for (i, _), row in zip(found, expected([t for _, t in found]))]

    def order(row):
        return (row[0] is None, row[0] or 0, row[1:])

    assert sorted(got, key=order) == sorted(want, key=order)


def test_no_documents(spark):
    assert alignment.digests(documents(spark, []), A_PATH, PATTERN, B_PATH).count() == 0


def test_gallop():
    rng = np.random.default_rng(0)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, rng.integers(5, 3000), rng.integers(0, 400))) for _ in range(2))
        assert np.array_equal(alignment.gallop(x, y, int(rng.integers(1, 70))), np.searchsorted(y, x))


def test_long_group():
    """A group of many tokens on both sides is paired by its different ids."""
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 50, 3000), rng.integers(0, 40, 2500)
    import pandas as pd

    ends = [alignment.bits(np.arange(len(v)) == len(v) - 1) for v in (a, b)]
    row = [a.astype("<u2").tobytes(), b.astype("<u2").tobytes(), *ends]
    part = alignment.Part(pd.DataFrame([row], columns=["a_ids", "b_ids", "a_last", "b_last"]), 100, 100)
    _, pairs, links = part.pairs()
    a_n, b_n = np.bincount(a), np.bincount(b)
    assert links.sum() == 3000 * 2500
    assert all(n == a_n[p // 100] * b_n[p % 100] for p, n in zip(pairs, links))
