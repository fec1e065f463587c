import bz2

import pytest
from helpers import rows
from pyspark.sql import functions as F

from topicmill.operators import counts, splitting
from topicmill.sources import documents


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "corpus"
    (root / "a").mkdir(parents=True)
    (root / "a" / "virtualdocument.txt.bz2").write_bytes(bz2.compress("école\tété rouge\nrouge\n".encode()))
    (root / "x.txt").write_text("plain words\nplain")
    (root / "bad.txt.bz2").write_bytes(b"BZh9 not really compressed")
    (root / "empty + odd name.txt").write_text("")
    (root / "latin.txt").write_bytes("caf\xe9 noir".encode("latin-1"))
    return root


def test_folder(spark, folder):
    corpus = documents.folder_corpus(spark, str(folder))
    assert rows(corpus.index, "doc_id", "read_error") == sorted([
        (f"{folder}/a/virtualdocument.txt.bz2", False),
        (f"{folder}/bad.txt.bz2", True),
        (f"{folder}/empty + odd name.txt", False),
        (f"{folder}/latin.txt", True),
        (f"{folder}/x.txt", False),
    ])
    bow = counts.bag_of_words_from_lines(corpus.lines).filter(~F.col("doc_id").endswith("latin.txt"))
    assert rows(bow, "doc_id", "token", "tf") == sorted([
        (f"{folder}/a/virtualdocument.txt.bz2", "cole", 1),
        (f"{folder}/a/virtualdocument.txt.bz2", "rouge", 2),
        (f"{folder}/x.txt", "plain", 2),
        (f"{folder}/x.txt", "words", 1),
    ])


def test_name_filter(spark, folder):
    corpus = documents.folder_corpus(spark, str(folder), "virtualdocument.txt.bz2", check=False)
    assert rows(corpus.index, "read_error") == [(None,)]
    assert corpus.lines.select("doc_id").distinct().count() == 1


@pytest.mark.parametrize("with_root", [False, True])
def test_manifest(spark, folder, tmp_path, with_root):
    manifest = tmp_path / "list.txt"
    manifest.write_text(f"{folder}/x.txt\n\n{folder}/missing.txt\n{folder}/a/virtualdocument.txt.bz2")
    corpus = documents.manifest_corpus(spark, str(manifest), str(folder) if with_root else None)
    assert rows(corpus.index, "doc_id", "read_error") == sorted([
        (f"{folder}/a/virtualdocument.txt.bz2", False),
        (f"{folder}/missing.txt", True),
        (f"{folder}/x.txt", False),
    ])
    assert rows(corpus.lines.select("doc_id").distinct(), "doc_id") == sorted(
        [(f"{folder}/a/virtualdocument.txt.bz2",), (f"{folder}/x.txt",)]
    )


def test_line_numbers_and_split(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"{n:04d}\n" for n in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = splitting.number_lines(documents.read_lines(spark, str(path)))
        assert rows(lines, "line_no", "text") == [(n, f"{n:04d}") for n in range(1000)]
        parts = splitting.split_documents(lines, "line_no", limit=999, newline_bytes=1)
        assert rows(parts.groupBy("segment").count(), "segment", "count") == [(s, 200) for s in range(5)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hidden_odd_and_damaged_files(spark, tmp_path):
    root = tmp_path / "a {b,c} [d] +%41"
    (root / ".folder").mkdir(parents=True)
    (root / "_x").write_text("hidden words\n\nhidden")
    (root / ".x").write_text("dotted")
    (root / ".folder" / "y.txt").write_text("inside")
    (root / "{a,b}.txt").write_text("braces")
    (root / "a.txt").write_text("plain")
    zipped = bz2.compress("\n".join(f"word{n} {n * n}" for n in range(400_000)).encode())
    (root / "cut.txt.bz2").write_bytes(zipped[: len(zipped) // 2])
    (root / "two.txt.bz2").write_bytes(bz2.compress(b"first\n") + bz2.compress(b"second\n"))

    corpus = documents.folder_corpus(spark, str(root))
    names = {r["doc_id"][len(str(root)) + 1 :]: r["read_error"] for r in corpus.index.collect()}
    assert names == {
        "_x": False, ".x": False, ".folder/y.txt": False, "{a,b}.txt": False, "a.txt": False,
        "cut.txt.bz2": True, "two.txt.bz2": False,
    }
    lines = {}
    for row in corpus.lines.collect():
        lines.setdefault(row["doc_id"][len(str(root)) + 1 :], []).append(row["text"])
    cut = lines.pop("cut.txt.bz2")
    assert 0 < len(cut) < 400_000
    assert {k: sorted(v) for k, v in lines.items()} == {
        "_x": ["", "hidden", "hidden words"], ".x": ["dotted"], ".folder/y.txt": ["inside"],
        "{a,b}.txt": ["braces"], "a.txt": ["plain"], "two.txt.bz2": ["first", "second"],
    }
    numbered = splitting.number_lines(corpus.lines).filter(F.col("doc_id").endswith("_x"))
    assert rows(numbered, "line_no", "text") == [(0, "hidden words"), (1, ""), (2, "hidden")]

    # One filter for index and lines: braces stand for themselves.
    some = documents.folder_corpus(spark, str(root), "{a,b}.*")
    assert rows(some.index, "doc_id") == rows(some.lines, "doc_id") == [(f"{root}/{{a,b}}.txt",)]

    manifest = tmp_path / "list.txt"
    wanted = [f"{root}/_x", f"{root}/.folder/y.txt", f"{root}/{{a,b}}.txt", f"{root}/none.txt"]
    manifest.write_text("\n".join(wanted))
    for base in (None, str(root)):
        listed = documents.manifest_corpus(spark, str(manifest), base)
        assert rows(listed.index, "doc_id", "read_error") == sorted((p, p.endswith("none.txt")) for p in wanted)
        assert rows(listed.lines.select("doc_id").distinct(), "doc_id") == sorted((p,) for p in wanted[:3])


def test_manifest_longer_than_a_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "PATHS_PER_BATCH", 30)
    folder = tmp_path / "many"
    folder.mkdir()
    for n in range(70):
        (folder / f"{n}.txt").write_text(f"number {n}")
    manifest = tmp_path / "list.txt"
    manifest.write_text("\n".join(f"{folder}/{n}.txt" for n in range(75)))
    corpus = documents.manifest_corpus(spark, str(manifest), check=False)
    assert corpus.index.count() == 75
    assert rows(corpus.lines, "text") == sorted((f"number {n}",) for n in range(70))
    assert documents.list_files(spark, str(folder)).count() == 70
