"""Operators on texts against brute force, an exact round trip and held-out accuracy."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from cases import documents, rows
from tokenizers import Tokenizer

from topicmill.llm import byte_bpe, catalog, common, lengths, packing, simhash, substring_dedup, suffix_dedup, toxicity

SF_DIR = "/root/testdata/sf0.001"
WORD_PATH = public_tokenizers.path(catalog.WORD_FILE)
BYTE_PATH = public_tokenizers.path(catalog.BYTE_FILE)


def encoded(text):
    text = text.decode() if isinstance(text, bytes) else text or ""
    return np.asarray(Tokenizer.from_file(WORD_PATH).encode(text, add_special_tokens=False).ids, "<u4")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def sort(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize("some", [None, []])
def test_packing_keeps_every_token_once(spark, some):
    found = packing.pack(documents(spark, some), WORD_PATH, capacity=256).collect()
    texts = rows() if some is None else some
    whole = Counter()
    for doc_id, text in texts:
        whole[(doc_id, np.append(encoded(text), np.uint32(1)).astype("<u4").tobytes())] += 1
    by_doc = {}
    for r in found:
        assert zlib.crc32(r["piece_ids"]) == r["ids_crc32"] and len(r["piece_ids"]) == 4 * r["length"]
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    # pieces of repeated rows interleave, so tokens are compared by place
    for (doc_id, tokens), pieces in by_doc.items():
        copies = [ids for (i, ids), n in whole.items() if i == doc_id and len(ids) == 4 * tokens for _ in range(n)]
        expected = Counter((at, ids[4 * at : 4 * at + 4]) for ids in copies for at in range(tokens))
        got = Counter((p["start"] + j, bytes(p["piece_ids"][4 * j : 4 * j + 4])) for p in pieces for j in range(p["length"]))
        assert got == expected
    assert sum(whole.values()) == 0 or {k[0] for k in by_doc} == {i for i, _ in texts}
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
        total += at
    assert padding <= 0.03 * total


def test_pieces_fill_their_class():
    for tokens in range(1, 5000, 7):
        pieces = packing.cut(tokens, 2048, 1 / 64)
        assert sum(pieces) == tokens
        assert all(p * (2048 // p) >= 2048 * (1 - 1 / 64) - 2048 // p for p in pieces)


def test_word_ids_equal_the_library(spark):
    from topicmill.llm.word_tokens import WordTokenizer

    texts = [t for _, t in rows()] + ["it's 'still' don't ΣΑΣ J̌ x\x0by", "a_b __ ʼn Ⱥ ١٢ ²½", "İx ẞ\x1c foo\x85bar"]
    for text, ids in zip(texts, WordTokenizer(WORD_PATH).encode_all(texts)):
        assert ids == encoded(text).tobytes()


def test_known_words_are_not_cut_again(monkeypatch):
    """A plain text of remembered words is looked up word by word, without the cut into runs."""
    from topicmill.llm import word_tokens

    texts = ["One two, (three) two-fold!\xa0x_1 " + "ab-" * 50, "Two, one"]
    coder = word_tokens.WordTokenizer(WORD_PATH)
    first = coder.encode_all(texts)
    assert first == [encoded(t).tobytes() for t in texts]
    cut = []
    monkeypatch.setattr(word_tokens, "RUNS", type("Runs", (), {"findall": lambda self, w: cut.append(w) or re.findall(r"[^\W\d_]+|(?:[^\w\s]|[\d_])+", w)})())
    assert coder.encode_all([*texts, "two, x_1 New"]) == [*first, encoded("two, x_1 New").tobytes()]
    assert sorted(cut) == ["ab-" * 50, "new"]  # the long one is not remembered
    monkeypatch.setattr(word_tokens, "REMEMBERED", 2)
    assert coder.encode_all(["some more words", *texts]) == [encoded("some more words").tobytes(), *first]


def test_context_limits(spark):
    found = lengths.context_limits(lengths.encoded_lengths(documents(spark), WORD_PATH)).collect()
    counts = [len(encoded(t)) for _, t in rows()]
    assert sorted(r["context_limit"] for r in found) == sorted(set(counts))
    for r in found:
        limit = r["context_limit"]
        assert r["docs"] == counts.count(limit)
        assert r["docs_within"] == sum(c <= limit for c in counts) and r["docs_over"] == sum(c > limit for c in counts)
        assert r["tokens_within"] == sum(c for c in counts if c <= limit)
        assert r["tokens_over"] == sum(c for c in counts if c > limit)
        assert r["truncated_tokens"] == sum(min(c, limit) for c in counts)
        assert r["quantile"] == r["docs_within"] / len(counts)
    assert lengths.context_limits(lengths.encoded_lengths(documents(spark, []), WORD_PATH)).count() == 0


def test_byte_bpe_round_trip(spark):
    coder = byte_bpe.ByteBpe(BYTE_PATH, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    docs = documents(spark)
    expected = [(i, library.encode_ordinary(t or "")) for i, t in rows()]
    ids = byte_bpe.encode(docs, BYTE_PATH, public_tokenizers.PATTERN)
    assert sort((r["doc_id"], r["ids"]) for r in ids.collect()) == sort(expected)
    back = byte_bpe.decode(ids, BYTE_PATH, public_tokenizers.PATTERN).collect()
    assert sort((r["doc_id"], bytes(r["bytes"])) for r in back) == sort((i, (t or "").encode()) for i, t in rows())
    digests = byte_bpe.round_trip(docs, BYTE_PATH, public_tokenizers.PATTERN).collect()
    named = [(i, len(x), sha(",".join(map(str, x)).encode()), sha((t or "").encode())) for (i, x), (_, t) in zip(expected, rows())]
    assert sort(tuple(r) for r in digests) == sort(named)
    assert byte_bpe.round_trip(documents(spark, []), BYTE_PATH, public_tokenizers.PATTERN).count() == 0


def test_long_pieces_merge_like_the_library():
    coder = byte_bpe.ByteBpe(BYTE_PATH, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text in ("a" * 3000, "theandfor" * 200, " " * 900, "日本" * 300, "x" * 256, "y" * 257, "z" * 65):
        (ids,) = coder.encode_all([text])
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


def simhash_of(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints):
    """Index of the first row of each row's group."""
    group = list(range(len(prints)))
    for _ in prints:
        for i in range(len(prints)):
            for j in range(len(prints)):
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    group[i] = min(group[i], group[j])
    return group


def test_near_duplicates(spark):
    table = rows()
    prints = [simhash_of(t) for _, t in table]
    group = groups_of(prints)
    least = {g: min((i for (i, _), k in zip(table, group) if k == g and i is not None), default=None) for g in group}
    expected = [(i, p, least[g]) for (i, _), p, g in zip(table, prints, group)]
    found = simhash.near_duplicates(documents(spark)).collect()
    assert sort((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == sort(expected)
    kept = simhash.representatives(documents(spark))
    assert kept.columns == documents(spark).columns
    assert kept.count() == len(set(group))
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == {v for v in least.values() if v is not None}
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.representatives(documents(spark, [])).count() == 0


def test_vantage_trees_lose_no_link():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64)) for _ in range(1200)]
    nodes = np.unique(np.concatenate((centres[rng.integers(0, 40, 1200)] ^ np.array(flips), rng.integers(0, 1 << 62, 800, dtype=np.uint64))))
    tree = simhash.ShardTree(nodes[::3], 16)
    assert tree.shards > 4
    parent = np.arange(len(nodes))
    where = list(tree.reach(nodes, 4))
    own = np.zeros(len(nodes), int)
    for shard, members, home in where:
        own[members[home]] = shard
    for shard, members, home in where:
        sent = own[members] >= shard
        root = simhash.shard_links(nodes[members[sent]], home[sent], 4)
        simhash._unite(parent, members[sent].copy(), members[sent][root].copy())
    while (parent != parent[parent]).any():
        parent = parent[parent]
    near = np.bitwise_count(nodes[:, None] ^ nodes[None]) <= 4
    group = np.arange(len(nodes))
    for _ in range(20):
        group = np.array([group[row].min() for row in near])
    assert (group == parent).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(200, 100), (300, 200), (7, 7), (900, 900)]
    found = common.components(spark.createDataFrame(chain, "a long, b long"), "test").collect()
    assert {r["node"]: r["component"] for r in found} == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100}
    assert len(found) == 54


def once(table):
    """Rows with equal id and text are one document; documents in the order of the operator."""
    return sorted(set(table), key=lambda r: (r[0] is not None, r[0] or 0))


def removed_bytes(table, length):
    seen, found = set(), {}
    for row in once(table):
        data = (row[1] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            string = data[at : at + length]
            if string in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(string)
        found[row] = (data, gone)
    return found


@pytest.mark.parametrize("shard_rows", [8192, 3])
def test_suffix_dedup(spark, shard_rows):
    # null ids come first and are told apart by a hash, so only one may hold a repeated passage
    table = [r for r in rows() if r != (None, rows()[-1][1])]
    expected = []
    found = removed_bytes(table, 100)
    for row in table:
        data, gone = found[row]
        runs = len(re.findall(b"\x01+", bytes(gone)))
        expected.append((row[0], len(data), sum(gone), runs, sha(bytes(b for b, g in zip(data, gone) if not g))))
    got = suffix_dedup.digests(documents(spark, table), 100, shard_rows).collect()
    assert sort(tuple(r) for r in got) == sort(expected)


def test_suffix_dedup_returns_documents(spark):
    cut = suffix_dedup.deduplicated(documents(spark))
    assert cut.columns == documents(spark).columns
    found = removed_bytes(rows(), 100)
    expected = []
    for row in rows():
        data, gone = found[row]
        kept, at = [], 0
        for letter in row[1] or "":  # a character goes if all its bytes do
            size = len(letter.encode())
            if not all(gone[at : at + size]):
                kept.append(letter)
            at += size
        expected.append((row[0], None if row[1] is None else "".join(kept)))
    assert sort((r["doc_id"], r["text"]) for r in cut.collect()) == sort(expected)
    assert suffix_dedup.digests(documents(spark, [])).count() == 0


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(1)
    for text in (b"a" * 300, b"abracadabra" * 30, bytes(rng.integers(0, 3, 800, dtype=np.uint8)), b"x"):
        order = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffix_dedup.common_prefixes(np.frombuffer(text, np.uint8), order, 40)
        for a, b in zip(order, order[1:]):
            full = next((n for n in range(41) if n == 40 or text[a + n : a + n + 1] != text[b + n : b + n + 1] or b + n >= len(text) or a + n >= len(text)), 40)
            assert shared[b] == full


def test_substring_dedup(spark):
    split = [(i, (t or "").encode().split()) for i, t in rows()]
    windows = Counter(tuple(w[p : p + 35]) for _, w in split for p in range(len(w) - 34))
    expected = []
    for i, words in split:
        gone = bytearray(len(words))
        for p in range(len(words) - 34):
            if windows[tuple(words[p : p + 35])] > 1:
                gone[p : p + 35] = b"\1" * 35
        kept = [w for w, g in zip(words, gone) if not g]
        expected.append((i, len(words), sum(gone), sha(b" ".join(kept))))
    got = substring_dedup.digests(documents(spark)).collect()
    assert sort(tuple(r) for r in got) == sort(expected)
    assert substring_dedup.digests(documents(spark, [])).count() == 0
    cut = substring_dedup.deduplicated(documents(spark))
    assert cut.columns == documents(spark).columns and cut.count() == len(rows())


def test_word_hashes_follow_the_blanks():
    data = b"  aa\tbb aa\x0bccc " + b"w" * 400 + b" aa"
    found = substring_dedup.word_hashes(data).tolist()
    words = data.split()
    assert len(found) == len(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert (a == b) == (found[i] == found[j])
    assert substring_dedup.word_hashes(b"").tolist() == []


def test_toxicity_learns_marked_words(spark):
    found = catalog.op7_toxicity(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.9
    assert len(found) == 1000 and all(0 <= r["score"] <= 1 for r in found)


def test_toxicity_cases(spark):
    docs = [(i, ("you awful fiend " if i % 2 else "what a fine day ") * 5 + f"number{i}") for i in range(1, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs] + [(None, 1), (5, None), (7, 1)], "doc_id long, toxic int")
    odd = docs + [(100, None), (101, ""), (None, "awful fiend"), docs[0]]
    settings = toxicity.Settings(least_documents=1)
    scored = toxicity.toxicity(documents(spark, odd), labels, settings, "score").collect()
    assert len(scored) == len(odd)
    by_text = {r["text"]: r["score"] for r in scored}
    assert by_text[None] == by_text[""] < 0.5
    assert all((by_text[t] >= 0.5) == bool(i % 2) for i, t in docs)
    assert toxicity.toxicity(documents(spark, []), labels, settings, "score").count() == 0
    none = toxicity.toxicity(documents(spark, docs), labels.filter("false"), settings, "score")
    assert {r["score"] for r in none.collect()} == {0.0}


def test_gradients():
    rng = np.random.default_rng(0)
    h = 3
    weights = {k: rng.standard_normal(s).astype(np.float64) for k, s in {"recur0": (h, 3 * h), "recur1": (h, 3 * h), "look": (2 * h, h), "ask": (h,), "out": (2 * h,), "bias": (1,)}.items()}
    inputs = rng.standard_normal((2, 4, 6 * h))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], np.float64)
    _, kept = toxicity.forward(weights, inputs, mask, keep=True)
    grads, dinputs = toxicity.backward(weights, mask, kept, np.ones(2))
    for name, at in (("recur0", (1, 4)), ("recur1", (2, 7)), ("look", (3, 1)), ("ask", (2,)), ("out", (4,))):
        near = {k: v.copy() for k, v in weights.items()}
        near[name][at] += 1e-3
        change = (toxicity.forward(near, inputs, mask).sum() - toxicity.forward(weights, inputs, mask).sum()) / 1e-3
        assert abs(change - grads[name][at]) < 2e-2 * max(1, abs(change))
    moved = inputs.copy()
    moved[0, 2, 5] += 1e-3
    change = (toxicity.forward(weights, moved, mask).sum() - toxicity.forward(weights, inputs, mask).sum()) / 1e-3
    assert abs(change - dinputs[0, 2, 5]) < 2e-2 * max(1, abs(change))
