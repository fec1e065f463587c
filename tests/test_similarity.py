import numpy as np
import pytest
from helpers import rows

from topicmill.operators import counts, dictionary, lsi, similarity, tfidf


def dense(table, num_docs=200):
    full = np.zeros((num_docs, table.size))
    for row in table.rows().collect():
        full[row["doc_id"], row["ids"]] = row["weights"]
    return full


def brute(vectors, groups, threshold):
    firsts = sorted({g for _, g in groups})
    unit = vectors[firsts] / np.linalg.norm(vectors[firsts], axis=1)[:, None]
    scores = np.triu(unit @ unit.T, 1)
    return {(firsts[i], firsts[j]): scores[i, j] for i, j in np.argwhere(scores >= threshold)}


def pairs_of(found):
    return {(r["doc_a"], r["doc_b"]): r["score"] for r in found.pairs.collect()}


@pytest.mark.parametrize("chunk_rows", [2000, 3])
@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.9])
def test_term_pairs_equal_brute_force(matrix, threshold, chunk_rows):
    found = similarity.similar_by_terms(matrix[1].rows(), threshold, chunk_rows)
    expected = brute(dense(matrix[1]), rows(found.groups, "doc_id", "group_id"), threshold or 1e-9)
    assert pairs_of(found) == pytest.approx(expected, abs=1e-9)


def test_pairs_by_hand_and_copies(spark, tiny):
    more = tiny.unionByName(tiny.selectExpr("doc_id + 10 as doc_id", "text"))
    words = dictionary.build_dictionary(counts.bag_of_words(more))
    found = similarity.similar_by_terms(tfidf.tfidf_vectors(more, words, 8).rows(), 0.0)
    assert rows(found.groups, "doc_id", "group_id") == [(1, 1), (2, 2), (3, 3), (11, 1), (12, 2), (13, 3)]
    assert pairs_of(found) == pytest.approx({(1, 2): 0.108465}, abs=1e-6)
    asked = spark.createDataFrame([(11,)], "doc_id bigint")
    assert [(d, o, round(s, 6)) for d, o, s in rows(found.rows_for(asked), "doc_id", "other_id", "score")] == [
        (11, 1, 1.0), (11, 2, 0.108465), (11, 11, 1.0), (11, 12, 0.108465),
    ]
    assert rows(found.most_similar(1), "group_id", "other_id", "rank") == [(1, 2, 1), (2, 1, 1)]


def test_singular_values(matrix):
    table = matrix[1]
    exact = np.linalg.svd(dense(table), compute_uv=False)
    space = lsi.fit_lsi(table, 200, k=150)
    assert space.values == pytest.approx(exact[:150], rel=1e-6)
    assert list(space.values) == sorted(space.values, reverse=True)
    assert (space.values**2).sum() <= (dense(table) ** 2).sum() + 1e-6


def test_few_directions(matrix):
    table = matrix[1]
    exact = np.linalg.svd(dense(table), compute_uv=False)
    space = lsi.fit_lsi(table, 200, k=4)
    assert space.values == pytest.approx(exact[:4], rel=1e-3)
    vectors = {r["doc_id"]: np.array(r["vector"]) for r in lsi.project(table, space).collect()}
    assert sum(v @ v for v in vectors.values()) == pytest.approx((space.values**2).sum(), rel=1e-6)


@pytest.mark.parametrize("chunk_rows", [2000, 7])
def test_full_space_gives_the_term_cosines(matrix, chunk_rows):
    table = matrix[1]
    space = lsi.fit_lsi(table, 200, k=200)
    groups = similarity.copy_groups(table.rows())
    found = similarity.similar_in_space(lsi.project(table, space), groups, 0.6, chunk_rows)
    expected = brute(dense(table), rows(groups, "doc_id", "group_id"), 0.6)
    assert pairs_of(found) == pytest.approx(expected, abs=1e-6)
