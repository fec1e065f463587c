"""Vector searches, URL verdicts and the pipeline."""

import numpy as np
import pytest
from cases import documents, vectors, whole

import corpus_pipeline
from topicmill.llm import pivot_search, projected_search, vector_blocks

SF_DIR = "/root/testdata/sf0.001"


def ids_and_matrix(spark):
    kept = whole([(r["vec_id"], r["embedding"]) for r in vectors(spark).collect()])
    return np.array([i for i, _ in kept]), np.array([v for _, v in kept])


@pytest.mark.parametrize("block", [4096, 16])
def test_products(spark, monkeypatch, block):
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", block)
    monkeypatch.setattr(vector_blocks, "BLOCK_QUERIES", block)
    monkeypatch.setattr(vector_blocks, "SAMPLE", 100)
    ids, values = ids_and_matrix(spark)
    whole_numbers = np.floor(64 * values).astype(np.int64)
    expected = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = whole_numbers @ whole_numbers[q]
        best = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        expected += [(int(ids[q]), n + 1, int(ids[i]), int(scores[i])) for n, i in enumerate(best)]
    got = pivot_search.top_products(vectors(spark)).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_few_and_no_vectors(spark):
    few = vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (20, [0.0, 1.0])])
    assert pivot_search.top_products(few).count() == 4
    assert projected_search.nearest(few).count() == 2
    assert pivot_search.top_products(vectors(spark, [])).count() == 0
    assert projected_search.nearest(vectors(spark, [])).count() == 0
    repeated = vectors(spark, [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])])
    assert [tuple(r)[1:3] for r in pivot_search.top_products(repeated).collect()] == [(1, 1), (2, 1)]


def test_neighbours(spark):
    ids, values = ids_and_matrix(spark)
    some = values.any(axis=1)
    ids, values = ids[some], values[some]
    got = {}
    for r in projected_search.nearest(vectors(spark)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = (values * values[q]).sum(1) / np.sqrt((values**2).sum(1)) / np.sqrt((values[q] ** 2).sum())
        best = [i for i in np.lexsort((ids, -np.round(scores, 12))) if i != q][:5]
        found = sorted(got[ids[q]])
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert np.allclose([s for _, _, s in found], [scores[np.flatnonzero(ids == i)[0]] for _, i, _ in found], atol=1e-12)
        hits += len({int(ids[i]) for i in best} & {i for _, i, _ in found})
        total += 5
    assert hits / total >= 0.9
    assert set(got) == set(ids[ids % 50 == 0].tolist())


def test_chi_square():
    assert abs(projected_search.chi_square_point(0.95, 8) - 15.507) < 1e-3


def test_pipeline_stages(spark):
    docs = documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.count() >= docs.count() > 0
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
