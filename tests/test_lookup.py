"""Look-ups of words by head and tail, and the bounds of similar rows."""

import numpy as np
import pytest
from helpers import rows
from test_similarity import brute, dense

from topicmill.operators import corpus, lookup, similarity, tfidf


@pytest.fixture
def hot(spark):
    """One known and one unknown word in all of 3,000 documents, and rare ones, a very long one included."""
    every = spark.range(3000).selectExpr("id as doc_id", "explode(array('all', 'gone')) as token", "id % 3 + 1 as tf")
    rare = spark.range(3000).selectExpr("id as doc_id", "concat('w', id % 700) as token", "1L as tf")
    long = spark.createDataFrame([(5, "x" * 500, 2), (6, "y" * 500, 1), (7, None, 1)], "doc_id long, token string, tf long")
    words = spark.range(600).selectExpr("concat('w', id) as token", "id as token_id")
    extra = spark.createDataFrame([("all", 1000), ("x" * 500, 1001)], "token string, token_id long")
    return every.unionByName(rare).unionByName(long), words.unionByName(extra)


def test_head_and_tail_give_the_plain_join(hot, monkeypatch):
    bow, words = hot
    whole = {f.__name__: rows(f(bow, words), *f(bow, words).columns[:1], "token_id", "tf")
             for f in (corpus.doc2bow, corpus.lookup_ids, corpus.doc2idx)}
    plain = bow.join(words, "token").select("doc_id", "token_id", "tf")
    assert whole["doc2bow"] == rows(plain, "doc_id", "token_id", "tf")
    assert len(whole["lookup_ids"]) == 9003
    monkeypatch.setattr(lookup, "HEAD_BYTES", 1000)
    for f in (corpus.doc2bow, corpus.lookup_ids, corpus.doc2idx):
        assert rows(f(bow, words), "doc_id", "token_id", "tf") == whole[f.__name__]


def test_frequent_words_are_not_shuffled(spark, hot, monkeypatch):
    """Without adaptive execution no task of the join gets a word of all documents, known or not."""
    bow, words = hot
    monkeypatch.setattr(lookup, "HEAD_BYTES", 1000)
    head = {r[0] for r in lookup.frequent_keys(bow, "token").collect()}
    assert {"all", "gone"} <= head and len(head) == 1000 // (lookup.LONGEST + lookup._ROW_BYTES)
    assert all(len(word) <= lookup.LONGEST for word in head)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookup.join_words(bow, words, "token", "left")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
        rare = found.filter(~found["token"].isin(*head)).groupBy("token").count()
        assert rare.agg({"count": "max"}).first()[0] <= 5
        assert found.count() == 9003
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_similar_rows_by_head_and_tail(matrix, monkeypatch):
    monkeypatch.setattr(lookup, "HEAD_BYTES", 2000)
    found = similarity.similar_by_terms(matrix[1].rows(), 0.5, 50)
    expected = brute(dense(matrix[1]), rows(found.groups, "doc_id", "group_id"), 0.5)
    pairs = {(r["doc_a"], r["doc_b"]): r["score"] for r in found.pairs.collect()}
    assert pairs == pytest.approx(expected, abs=1e-9)


def earlier_candidates(unique, threshold):
    """Pairs by the bound on lengths alone: the shared part plus the longer of the two rests."""
    ids = {r["doc_id"]: (r["ids"], r["weights"]) for r in unique.collect()}
    df = {}
    for words, _ in ids.values():
        for word in words:
            df[word] = df.get(word, 0) + 1
    signed = {}
    for doc, (words, weights) in ids.items():
        kept, squares = {}, 0.0
        for _, word, weight in sorted((df[w], w, x) for w, x in zip(words, weights)):
            if np.sqrt(max(1 - squares, 0)) < threshold * 0.7 - 1e-9:
                break
            kept[word] = weight
            squares += weight * weight
        signed[doc] = kept, np.sqrt(max(1 - squares, 0))
    found = set()
    for a, (one, rest_a) in signed.items():
        for b, (two, rest_b) in signed.items():
            common = one.keys() & two.keys()
            if a < b and common and sum(one[w] * two[w] for w in common) + max(rest_a, rest_b) >= threshold - 1e-9:
                found.add((a, b))
    return found


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.9])
def test_bounds_drop_pairs_and_lose_none(matrix, threshold):
    unique = similarity.representatives(matrix[1].rows(), similarity.copy_groups(matrix[1].rows()))
    signature = similarity.signatures(unique, threshold)
    found = {tuple(r) for r in similarity.candidates(signature, threshold).collect()}
    exact = brute(dense(matrix[1]), [(0, r["doc_id"]) for r in unique.select("doc_id").collect()], threshold)
    earlier = earlier_candidates(unique, threshold)
    print(threshold, len(exact), len(found), len(earlier))
    assert set(exact) <= found
    assert len(found) < len(earlier)
