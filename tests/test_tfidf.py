import math

import pytest
from helpers import rows

from topicmill.operators import counts, dictionary, tfidf


def weights_of(table):
    return {(r["doc_id"], r["token_id"]): r["weight"] for r in table.entries().collect()}


def test_weights_by_hand(tiny):
    bow = counts.bag_of_words(tiny)
    idf = tfidf.fit_idf(counts.document_frequency(bow), 4)
    assert rows(idf, "token", "idf") == [("blue", 1.0), ("cole", 2.0), ("green", 2.0), ("red", 2.0)]
    found = {(r["doc_id"], r["token"]): r["weight"] for r in tfidf.tfidf(bow, idf).collect()}
    root = math.sqrt(17)
    assert found == pytest.approx({
        (1, "red"): 4 / root, (1, "blue"): 1 / root,
        (2, "blue"): 1 / math.sqrt(5), (2, "green"): 2 / math.sqrt(5), (3, "cole"): 1.0,
    })


def test_word_in_every_document_has_no_weight(spark):
    docs = spark.createDataFrame([(1, "all one"), (2, "all two"), (3, "all")], "doc_id bigint, text string")
    words = dictionary.build_dictionary(counts.bag_of_words(docs))
    table = tfidf.tfidf_vectors(docs, words, 3)
    assert weights_of(table) == {(1, 1): 1.0, (2, 2): 1.0}
    assert table.features().count() == 3


def test_matrix_has_every_document(spark, matrix):
    from helpers import SF_DIR
    from topicmill.plans import catalog

    words, table = matrix
    weights = tfidf.tfidf(catalog.bow(spark, SF_DIR), tfidf.fit_idf(words, 200)).join(
        words.select("token", "token_id"), "token"
    )
    expected = {(r["doc_id"], r["token_id"]): r["weight"] for r in weights.collect()}
    assert weights_of(table) == pytest.approx(expected, abs=1e-12)
    assert table.features().count() == 200 and table.size == 1669
    assert table.entries().count() == 20_089
    assert table.features().first()["features"].size == 1669


def test_rows_have_length_one(matrix):
    for row in matrix[1].rows().collect():
        assert sum(w * w for w in row["weights"]) == pytest.approx(1.0)
        assert list(row["ids"]) == sorted(row["ids"])
