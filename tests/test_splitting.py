import random

import numpy as np
import pytest
from helpers import rows

from topicmill.operators import splitting
from topicmill.plans.pipeline import Corpus
from topicmill.sources import documents


def plain(sizes, limit):
    held, segment, result = 0, 0, []
    for size in sizes:
        if held > limit:
            held, segment = 0, segment + 1
        held += size
        result.append(segment)
    return result


def test_by_hand(spark):
    lines = spark.createDataFrame([("d", n, "abc") for n in range(4)], "doc_id string, n bigint, text string")
    found = splitting.split_documents(lines, "n", limit=5)
    assert rows(found, "n", "segment") == [(0, 0), (1, 0), (2, 1), (3, 1)]
    assert rows(splitting.as_documents(found), "doc_id", "text") == [("d#0", "abc")] * 2 + [("d#1", "abc")] * 2


@pytest.mark.parametrize("per_block", [1, 4, 1000])
def test_any_block_size_gives_the_same_cuts(spark, per_block):
    random.seed(per_block)
    sizes = {d: [random.choice([0, 1, 5, 40]) for _ in range(60)] for d in (1, 2, 3)}
    lines = spark.createDataFrame(
        [(d, n, "x" * s) for d, many in sizes.items() for n, s in enumerate(many)],
        "doc_id bigint, n bigint, text string",
    ).repartition(5)
    found = splitting.split_documents(lines, "n", limit=30, lines_per_block=per_block)
    expected = [(d, n, s) for d, many in sizes.items() for n, s in enumerate(plain(many, 30))]
    assert rows(found, "doc_id", "n", "segment") == sorted(expected)


def test_jumps_of_any_stretches():
    """Jumps of neighbours put together equal those of all lines, and lead to the plain cuts."""
    rng = np.random.default_rng(5)
    for limit in (0, 1, 7, 100):
        for _ in range(40):
            sizes = rng.choice([0, 0, 1, 3, 9, 200], rng.integers(1, 60))
            cuts = np.sort(rng.integers(0, len(sizes) + 1, 3))
            parts = [p for p in np.split(sizes, cuts) if len(p)]
            threshold, segments = limit, 0
            for part in parts:
                opened, leave = splitting._Jumps.of_lines(part, limit).after(np.array([threshold]))
                threshold, segments = int(leave[0]), segments + int(opened[0])
            assert segments == plain(sizes, limit)[-1]
            whole = splitting._Jumps.of_lines(parts[0], limit)
            for part in parts[1:]:
                whole = whole.then(splitting._Jumps.of_lines(part, limit), limit)
            entries = np.arange(-5, limit + 1)
            direct = splitting._Jumps.of_lines(sizes, limit)
            assert whole.total == direct.total
            for left, right in zip(whole.after(entries), direct.after(entries)):
                assert left.tolist() == right.tolist()


def test_many_levels(spark):
    """200 blocks of 3 lines: three levels, with a short document and a gap in the lines beside."""
    random.seed(11)
    sizes = {"long": [random.choice([0, 1, 5, 40, 90]) for _ in range(600)], "short": [7]}
    rows_of = [(d, n, "x" * s) for d, many in sizes.items() for n, s in enumerate(many)]
    gap = [("gap", n, "x" * 20) for n in (*range(4), *range(500, 504))]
    lines = spark.createDataFrame(rows_of + gap, "doc_id string, n bigint, text string").repartition(4)
    found = splitting.split_documents(lines, "n", limit=50, lines_per_block=3)
    expected = [(d, n, s) for d, many in sizes.items() for n, s in enumerate(plain(many, 50))]
    expected += [("gap", n, s) for (_, n, _), s in zip(gap, plain([20] * 8, 50))]
    assert rows(found, "doc_id", "n", "segment") == sorted(expected)


def test_split_corpus_counts_every_line_once(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"word line{'abc'[n % 3]}\n" for n in range(100)))
    (tmp_path / "empty.txt").write_text("")
    text = documents.folder_corpus(spark, str(tmp_path))
    corpus = Corpus.from_text("split", text, split_bytes=200)
    names = [r[0].removeprefix(f"{tmp_path}/") for r in rows(corpus.index, "doc_id")]
    sizes = [len("word linea\n")] * 100
    assert names == sorted(["empty.txt#0", *{f"long.txt#{s}" for s in plain(sizes, 200)}])
    of_word = corpus.bow.filter("token = 'word'").groupBy().sum("tf").first()[0]
    assert of_word == 100
    whole = {r[0]: r[1] for r in rows(Corpus.from_text("whole", text).bow.groupBy("token").sum("tf"), "token", "sum(tf)")}
    assert {r[0]: r[1] for r in rows(corpus.bow.groupBy("token").sum("tf"), "token", "sum(tf)")} == whole
