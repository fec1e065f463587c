import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from topicmill.operators import counts, lda
from topicmill.plans.pipeline import (
    Corpus,
    Limits,
    compute_similarity,
    compute_topics,
    infer_topics,
    prepare,
    refresh,
)
from topicmill.session import shared_folder
from topicmill.sinks import reports
from topicmill.sources import documents


def text_of(path):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    return "".join(open(os.path.join(path, n)).read() for n in names)


def test_topics_then_again_with_other_limits(spark, tiny, tmp_path):
    out = str(tmp_path / "out")
    source = Corpus.from_table("tiny", tiny)
    result = compute_topics(source, out, topic_counts="1,2".split(","), terms_per_topic=3)
    assert rows(result["index"], "doc_no", "doc_id", "read_error") == [
        (n, n + 1, False) for n in range(4)
    ]
    assert result["doc_topics"].select("doc_id", "k").distinct().count() == 8
    assert result["perplexity"].count() == 2
    (corpus,) = os.listdir(out)
    (first,) = [n for n in os.listdir(f"{out}/{corpus}") if n.startswith("limits-")]
    (topics_folder,) = [n for n in os.listdir(f"{out}/{corpus}/{first}") if n.startswith("topics-")]
    report = f"{out}/{corpus}/{first}/{topics_folder}/reports"
    assert sorted(os.listdir(f"{out}/{corpus}/{first}/{topics_folder}/lda_model")) == ["k=1", "k=2"]
    topics = text_of(f"{report}/2_TF-IDF/topics.txt").splitlines()
    assert topics[0] == "Topic #0" and topics[4] == "Topic #1" and len(topics) == 8
    assert topics[1].startswith("\t") and topics[1].count("\t") == 2
    shares = text_of(f"{report}/1_TF-IDF/doc_id_to_topic.txt").splitlines()
    assert shares[:2] == ["Doc #0", "\t1.0 on topic #0"] and len(shares) == 8
    assert text_of(f"{report}/doc_id_to_path.txt").splitlines()[3] == "Doc #3\t4"

    before = os.stat(f"{out}/{corpus}/bag_of_words/_SUCCESS").st_mtime_ns
    compute_topics(source, out, Limits(no_below=2), [1])
    assert os.stat(f"{out}/{corpus}/bag_of_words/_SUCCESS").st_mtime_ns == before
    assert len([n for n in os.listdir(f"{out}/{corpus}") if n.startswith("limits-")]) == 2


def shares_of(result):
    return {tuple(r[:3]): r[3] for r in result["doc_topics"].select("k", "doc_id", "topic_id", "weight").collect()}


def job_folders(spark):
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    return {n for n in os.listdir(folder) if n.startswith("job-")} if os.path.isdir(folder) else set()


def test_saved_models_know_old_and_new_documents(spark, tmp_path, monkeypatch):
    words = ["red", "blue", "green", "black", "white"]
    texts = [(n, f"{words[n % 5]} {words[n % 3]} {words[n % 2]} " * (1 + n % 4)) for n in range(40)] + [(99, "")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    source, out = Corpus.from_table("colours", docs), str(tmp_path / "out")
    limits = Limits(no_below=1, no_above=0.9)
    first = compute_topics(source, out, limits, [1, 2, 3])
    expected = shares_of(first)
    assert not job_folders(spark)

    # A second run loads the models: fitting is not even possible.
    with monkeypatch.context() as m:
        m.setattr(lda, "fit_sweep", None)
        again = compute_topics(source, out, limits, [1, 2, 3])
        assert again.folder == first.folder
        assert shares_of(again).keys() == expected.keys()
        assert all(abs(w - expected[key]) < 1e-9 for key, w in shares_of(again).items())

    # New documents with the texts of old ones get their topics; unknown words count for nothing.
    fresh = docs.select((F.col("doc_id") + 1000).alias("doc_id"), F.concat("text", F.lit(" unheard")).alias("text"))
    found = infer_topics(Corpus.from_table("fresh", fresh), first.folder, str(tmp_path / "new"))
    shares = shares_of(found)
    assert {(k, d - 1000, t) for k, d, t in shares} == expected.keys()
    assert all(abs(w - expected[k, d - 1000, t]) < 1e-9 for (k, d, t), w in shares.items())
    assert not job_folders(spark)


def test_clean_empties_the_corpus_folder(spark, tiny, tmp_path):
    out = str(tmp_path / "out")
    source = Corpus.from_table("tiny", tiny)
    old = compute_topics(source, out, Limits(no_below=1, no_above=1.0), [1])
    new = compute_topics(source, out, Limits(no_below=2, no_above=1.0), [1], clean=True)
    assert not os.path.exists(old.folder) and os.path.exists(new.folder)
    assert new["index"].count() == 4


def test_similarity_of_text_files(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for name, text in {"a": "red red blue", "b": "blue green", "c": "red red blue", "d": ""}.items():
        (folder / f"{name}.txt").write_text(text)
    source = Corpus.from_text("files", documents.folder_corpus(spark, str(folder)))
    result = compute_similarity(source, str(tmp_path / "out"), dimensions=10, threshold=0.01)
    groups = {os.path.basename(d): os.path.basename(g) for d, g in rows(result["groups"], "doc_id", "group_id")}
    assert groups == {"a.txt": "a.txt", "b.txt": "b.txt", "c.txt": "a.txt"}
    assert result["pairs"].count() == 1


def test_matrix_market(spark, tiny, tmp_path):
    index = reports.number_documents(documents.table_index(tiny))
    entries = spark.createDataFrame([(1, 0, 2), (3, 1, 1)], "doc_id bigint, token_id bigint, tf bigint")
    path = str(tmp_path / "corpus.mm")
    reports.write_matrix_market(entries, index, 2, "tf", path)
    assert text_of(path).splitlines() == [
        "%%MatrixMarket matrix coordinate integer general", "4 2 2", "1 1 2", "3 2 1",
    ]


def by_words(ready):
    """Document and word to weight: what does not depend on the numbers of words."""
    names = ready.dictionary.select("token_id", "token")
    found = ready.vectors.entries().join(names, "token_id").select("doc_id", "token", "weight").collect()
    return {(r["doc_id"], r["token"]): r["weight"] for r in found}


def test_refresh_equals_a_full_rebuild(spark, tmp_path, monkeypatch):
    old = [(n, f"often {'usual' if n % 2 else 'other'} {'late' if n == 3 else ''} word{'abcdefgh'[n % 8]}") for n in range(20)]
    new = [(n, f"usual late novel {'word' + 'aij'[n % 3]} often") for n in range(100, 112)] + [(200, ""), (201, None)]
    table = lambda rows_: spark.createDataFrame(rows_, "doc_id bigint, text string")
    out, limits = str(tmp_path / "out"), Limits(no_below=2, no_above=0.6)
    before = prepare(Corpus.from_table("old", table(old)), out, limits)
    whole = prepare(Corpus.from_table("whole", table(old + new)), out, limits)
    fresh = Corpus.from_table("fresh", table(new))

    monkeypatch.setattr(counts, "bag_of_words", None)  # nothing tokenises again
    source = refresh("old", fresh, "refreshed", out, limits)
    found = prepare(source, out, limits)
    assert rows(found.dictionary, "token", "df", "cf") == rows(whole.dictionary, "token", "df", "cf")
    expected, weights = by_words(whole), by_words(found)
    assert weights.keys() == expected.keys()
    assert weights == pytest.approx(expected, abs=1e-12)
    assert found.num_docs == 34 and found.vectors.features().count() == 34

    # "late" is admitted now, "usual" is too frequent now; numbers of other words and documents stay.
    ids, old_ids = dict(rows(found.dictionary, "token", "token_id")), dict(rows(before.dictionary, "token", "token_id"))
    assert "late" in ids and "late" not in old_ids and "usual" in old_ids and "usual" not in ids
    assert {t: i for t, i in old_ids.items() if t in ids} == {t: ids[t] for t in old_ids if t in ids}
    assert len(set(ids.values())) == len(ids)
    assert rows(found.index.filter("doc_no < 20"), "doc_no", "doc_id") == rows(before.index, "doc_no", "doc_id")
    assert [r[0] for r in rows(found.index, "doc_no")] == list(range(34))

    # Another refresh goes on from it.
    monkeypatch.undo()
    last = Corpus.from_table("last", table([(300, "usual wordk wordk"), (301, "wordk late")]))
    again = prepare(refresh("refreshed", last, "again", out, limits), out, limits)
    rebuilt = prepare(Corpus.from_table("all", table(old + new + [(300, "usual wordk wordk"), (301, "wordk late")])), out, limits)
    assert by_words(again) == pytest.approx(by_words(rebuilt), abs=1e-12)

    with pytest.raises(ValueError):
        refresh("old", Corpus.from_table("twice", table(old[:1])), "clash", out, limits)
    with pytest.raises(ValueError):
        refresh("unheard", fresh, "none", out, limits)
