from helpers import rows

from topicmill.operators import corpus, counts, dictionary
from topicmill.operators.numbering import number_by
from topicmill.sources import wordlists


def words(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "word string")


def test_bag_of_words(tiny):
    expected = [(1, "blue", 1), (1, "red", 2), (2, "blue", 1), (2, "green", 1), (3, "cole", 1)]
    assert rows(counts.bag_of_words(tiny), "doc_id", "token", "tf") == expected
    assert rows(counts.bag_of_words_from_lines(tiny), "doc_id", "token", "tf") == expected


def test_null_text_is_an_empty_document(spark):
    docs = spark.createDataFrame([(1, None), (2, "two words")], "doc_id bigint, text string")
    assert counts.bag_of_words(docs).count() == 2
    assert tuple(counts.corpus_stats(docs).first()) == (2, 2, 2)


def test_stats(tiny):
    assert tuple(counts.corpus_stats(tiny).first()) == (4, 6, 5)
    terms = counts.term_statistics(counts.bag_of_words(tiny))
    assert tuple(counts.stats_from_terms(terms, 4).first()) == (4, 6, 5)


def test_dictionary_ids_follow_token_order(tiny):
    built = dictionary.build_dictionary(counts.bag_of_words(tiny))
    assert rows(built, "token", "token_id", "df", "cf") == [
        ("blue", 0, 2, 2), ("cole", 1, 1, 1), ("green", 2, 1, 1), ("red", 3, 1, 2),
    ]


def test_limits_keepwords_and_stopwords(spark, tiny):
    terms = counts.term_statistics(counts.bag_of_words(tiny))
    keep, stop = words(spark, "red"), words(spark, "RED")
    assert rows(dictionary.filter_extremes(terms, 4, 2, 1.0), "token") == [("blue",)]
    assert rows(dictionary.filter_extremes(terms, 4, 2, 1.0, keep), "token") == [("blue",), ("red",)]
    assert rows(dictionary.filter_dictionary(terms, 4, 2, 1.0, stop, keep), "token") == [("blue",)]


def test_upper_limit_is_cut_to_a_whole_number():
    assert dictionary.upper_limit(0.5, 5) == 2


def test_unknown_words(spark, tiny):
    bow = counts.bag_of_words(tiny)
    known = spark.createDataFrame([("blue", 0)], "token string, token_id bigint")
    assert rows(counts.unknown_counts(bow, known), "doc_id", "unknown_tf") == [(1, 2), (2, 1), (3, 1)]
    assert rows(corpus.doc2idx(bow, known), "doc_id", "token_id", "tf") == [
        (1, -1, 2), (1, 0, 1), (2, -1, 1), (2, 0, 1), (3, -1, 1),
    ]
    assert rows(corpus.doc2bow(bow, known), "doc_id", "token_id", "tf") == [(1, 0, 1), (2, 0, 1)]


def test_merge_keeps_known_ids(spark):
    schema = "token string, token_id bigint, df bigint, cf bigint"
    base = spark.createDataFrame([("m", 0, 1, 1), ("z", 1, 2, 3)], schema)
    other = spark.createDataFrame([("b", 0, 1, 4), ("a", 1, 1, 1), ("z", 2, 5, 5)], schema)
    assert rows(dictionary.merge_dictionaries(base, other), *base.columns) == [
        ("a", 2, 1, 1), ("b", 3, 1, 4), ("m", 0, 1, 1), ("z", 1, 7, 8),
    ]
    stats = spark.createDataFrame([(1, 2, 3)], "num_docs bigint, num_pos bigint, num_nnz bigint")
    assert tuple(dictionary.merge_stats(stats, stats).first()) == (2, 4, 6)


def test_numbers_are_dense_over_many_partitions(spark):
    df = spark.range(20_000).selectExpr("sha2(cast(id as string), 256) as k").repartition(13)
    found = [r["k"] for r in number_by(df, "k", "n", first=5).orderBy("n").collect()]
    assert found == sorted(found)
    assert number_by(df, "k", "n", first=5).agg({"n": "max"}).first()[0] == 20_004


def test_word_lists(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("url\n\nurl\nth")
    assert rows(wordlists.word_list(wordlists.word_file(spark, str(path))), "word") == [("th",), ("url",)]
    assert wordlists.default_stopwords(spark).distinct().count() == 73
