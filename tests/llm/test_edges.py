"""Characters at cuts, columns with odd names, vectors of extreme length."""

import numpy as np
from cases import documents
from pyspark.sql import functions as F

from topicmill.llm import projected_search, simhash, substring_dedup, suffix_dedup


def test_cuts_make_no_characters_up():
    text = "\u013caa\u0168b"  # c4 bc 61 61 c5 a8 62
    assert suffix_dedup.kept_text(text, [(1, 5)]) == "\u013c\u0168b"
    assert suffix_dedup.kept_text(text, [(0, 4)]) == "\u0168b"
    assert suffix_dedup.kept_text(text, [(0, 7)]) == "" and suffix_dedup.kept_text(text, [(1, 2)]) == text


def test_columns_with_dots(spark):
    docs = documents(spark).withColumn("a.b", F.col("lang")).withColumn("c`d", F.col("lang"))
    for found in (suffix_dedup.deduplicated(docs), simhash.representatives(docs), substring_dedup.deduplicated(docs)):
        assert found.columns == docs.columns and found.count() > 0


def test_very_long_and_short_vectors(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (50, [1.0, 0.0]), (100, [1e-200, 1e-200]), (101, [-1e-300, 0.0])]
    found = projected_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = {(r["query_id"], r["vec_id"]): (r["rank"], r["score"]) for r in found}
    assert len(got) == 3 * 4 and all(np.isfinite(s) for _, s in got.values())
    assert got[0, 1] == (1, 1.0) and got[0, 101] == (4, -1.0)
    assert abs(got[50, 100][1] - 0.5**0.5) < 1e-15 and abs(got[100, 0][1] - 0.5**0.5) < 1e-15
