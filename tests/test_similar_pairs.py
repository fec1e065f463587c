import duckdb
import numpy as np
from compare import difference

import __spark_entry__ as contract


def test_tfidf_similarity_gives_every_pair_with_its_score(spark, tmp_path):
    """Not a count of pairs: which two rows they are, and how alike; copies are one row."""
    rng = np.random.default_rng(8)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "abcde"]
    texts = []
    for n in range(60):
        base = texts[rng.integers(n)].split()[:9] if n % 3 == 2 else []
        texts.append(" ".join([*base, *rng.choice(words, 12 - len(base))]))
    texts += [texts[4], "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "tfidf_similarity"
    sql = contract.oracle_sql()[name]
    assert difference(spark, database, contract.queries()[name], sql, str(tmp_path)) is None
    found = database.sql(sql)
    assert found.columns == ["doc_a", "doc_b", "score"]
    pairs = {(a, b): s for a, b, s in found.fetchall()}
    assert len(pairs) > 5 and all(a < b < 60 and 0.7 <= s < 1 for (a, b), s in pairs.items())
