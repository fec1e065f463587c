"""The packing stage keeps the ids of its pieces."""

import public_tokenizers
from cases import documents

import corpus_pipeline
from topicmill.llm import catalog, packing


def test_pieces_keep_their_ids(spark):
    docs = documents(spark, [(1, "one word's"), (2, "three more words"), (3, None)])
    got = corpus_pipeline.STAGES[-1][1](spark, docs, "unused")
    expected = packing.pack(docs, public_tokenizers.path(catalog.WORD_FILE))
    assert "piece_ids" in got.columns and got.columns == expected.columns
    ids = lambda df: {(r["doc_id"], r["start"]): bytes(r["piece_ids"]) for r in df.collect()}
    assert ids(got) == ids(expected) and all(ids(got).values())
