"""ANSI SQL over the same tables, one statement per query with an exact answer."""

from __future__ import annotations


def _with(parts: list[tuple[str, str]], select: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n" + select


def _tokens(table: str, key: str, text: str) -> str:
    return (
        f"SELECT {key} AS doc_id, "
        f"unnest(regexp_extract_all(lower({text}), '[a-z][a-z]+')) AS token FROM {table}"
    )


_BOW = "SELECT doc_id, token, count(*) AS tf FROM {} GROUP BY doc_id, token"
_TERMS = "SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {} GROUP BY token"
_LIMIT = "df >= {} AND df <= CAST(floor({} * (SELECT count(*) FROM {})) AS BIGINT)"

TOKENS = ("tokens", _tokens("documents", "doc_id", "text"))
BOW = ("bow", _BOW.format("tokens"))
TERMS = ("terms", _TERMS.format("bow"))
IN_RANGE = _LIMIT.format(5, 0.5, "documents")
LIMITED = ("limited", f"SELECT * FROM terms WHERE {IN_RANGE}")
DICTIONARY = (
    "dictionary",
    "SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id, df, cf FROM limited",
)
IDF = (
    "idf",
    "SELECT token, df, log2((SELECT count(*) FROM documents) / CAST(df AS DOUBLE)) AS idf FROM limited",
)
RAW = (
    "raw",
    "SELECT doc_id, token, tf * idf AS weight FROM bow JOIN idf USING (token)",
)
TFIDF = (
    "tfidf",
    "SELECT * FROM (SELECT doc_id, token, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight "
    "FROM raw WHERE abs(weight) > 1e-12) AS scaled WHERE abs(weight) > 1e-12",
)
PAGE_TOKENS = ("page_tokens", _tokens("pages", "page_id", "html"))
PAGE_BOW = ("page_bow", _BOW.format("page_tokens"))
PAGE_TERMS = ("page_terms", _TERMS.format("page_bow"))
ITEM_TOKENS = ("item_tokens", _tokens("benchmark", "item_id", "text"))
ITEM_BOW = ("item_bow", _BOW.format("item_tokens"))

# The expected default stop words, written out apart from the library's own list.
_EXPECTED_WORDS = r"""
xc ΄ xce * zip xaf % ! purl fri > . type xad xb owl = xbf archiveformat tar @ tue xd { xbe ] " <
url xbc skos xaa rdfs , ; xmlns ) : gnu dc / # ` rdf string label ^ sun mon } xe $ thu wed [ ? sat
( ' xcf dcterms - org www html json ttl fn xmlschema xsd http float th
""".split()
_DEFAULT_WORDS = ", ".join("('" + w.replace("'", "''") + "')" for w in _EXPECTED_WORDS)
STOP = (
    "stop",
    f"SELECT DISTINCT word FROM (SELECT word FROM (VALUES {_DEFAULT_WORDS}) AS v(word) "
    "UNION ALL SELECT lower(lang) FROM documents "
    "UNION ALL SELECT unnest(string_split(lower(n_name), ' ')) FROM nation) AS s WHERE length(word) > 0",
)
KEEP = ("keep", "SELECT DISTINCT token AS word FROM item_tokens")

_CORPUS = [TOKENS, BOW]
_TO_TERMS = [*_CORPUS, TERMS]
_TO_LIMITED = [*_TO_TERMS, LIMITED]
_TO_DICTIONARY = [*_TO_LIMITED, DICTIONARY]
_TO_RAW = [*_TO_LIMITED, IDF, RAW]
_TO_TFIDF = [*_TO_RAW, TFIDF]

TOTALS = ("totals", "SELECT token, sum(weight) AS total FROM tfidf GROUP BY token")
PRINTS = (
    "prints",
    "SELECT doc_id, list(token || ' ' || CAST(round(weight, 9) AS VARCHAR) ORDER BY token) AS print "
    "FROM tfidf GROUP BY doc_id",
)
GROUPS = (
    "groups",
    "SELECT doc_id, min(doc_id) OVER (PARTITION BY print) AS group_id FROM prints",
)
FIRSTS = (
    "firsts",
    "SELECT tfidf.* FROM tfidf JOIN groups ON tfidf.doc_id = groups.group_id AND groups.doc_id = groups.group_id",
)

SQL: dict[str, str] = {
    "scan_documents": "SELECT doc_id, text FROM documents",
    "document_index": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_no, doc_id, "
    "text IS NULL AS read_error FROM documents",
    "stopword_list": _with([STOP], "SELECT word FROM stop"),
    "keepword_list": _with([ITEM_TOKENS, KEEP], "SELECT word FROM keep"),
    "tokenize": "SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens "
    "FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z]+') AS t FROM documents) AS s",
    "doc_tokens": _with([TOKENS], "SELECT doc_id, token FROM tokens"),
    "bag_of_words": _with(_CORPUS, "SELECT doc_id, token, tf FROM bow"),
    "bag_of_words_from_lines": _with(
        [("turn_tokens", _tokens("conversations", "conv_id", "text"))], _BOW.format("turn_tokens")
    ),
    "document_frequency": _with(_TO_TERMS, "SELECT token, df FROM terms"),
    "collection_frequency": _with(_TO_TERMS, "SELECT token, cf FROM terms"),
    "corpus_stats": _with(
        _CORPUS,
        "SELECT (SELECT count(*) FROM documents) AS num_docs, CAST(sum(tf) AS BIGINT) AS num_pos, "
        "count(*) AS num_nnz FROM bow",
    ),
    "build_dictionary": _with(
        _TO_TERMS,
        "SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id, df, cf FROM terms",
    ),
    "merge_dictionaries": _with(
        [
            *_TO_TERMS,
            PAGE_TOKENS,
            PAGE_BOW,
            PAGE_TERMS,
            ("known", "SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id FROM terms"),
            (
                "fresh",
                "SELECT token, (SELECT count(*) FROM known) + row_number() OVER (ORDER BY token) - 1 AS token_id "
                "FROM page_terms WHERE token NOT IN (SELECT token FROM known)",
            ),
            ("ids", "SELECT * FROM known UNION ALL SELECT * FROM fresh"),
            ("both_terms", "SELECT * FROM terms UNION ALL SELECT * FROM page_terms"),
        ],
        "SELECT token, token_id, CAST(sum(df) AS BIGINT) AS df, CAST(sum(cf) AS BIGINT) AS cf "
        "FROM both_terms JOIN ids USING (token) GROUP BY token, token_id",
    ),
    "filter_extremes": _with(_TO_DICTIONARY, "SELECT token, token_id, df, cf FROM dictionary"),
    "filter_keepwords": _with(
        [*_TO_TERMS, ITEM_TOKENS, KEEP],
        f"SELECT token, df, cf FROM terms WHERE ({IN_RANGE}) OR token IN (SELECT word FROM keep)",
    ),
    "filter_stopwords": _with(
        [PAGE_TOKENS, PAGE_BOW, PAGE_TERMS, STOP, ITEM_TOKENS, KEEP],
        f"SELECT token, df, cf FROM page_terms WHERE (({_LIMIT.format(5, 0.5, 'pages')}) "
        "OR token IN (SELECT word FROM keep)) AND token NOT IN (SELECT lower(word) FROM stop)",
    ),
    "dictionary_refilter": _with(
        [*_TO_TERMS, STOP],
        "SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id, df, cf FROM terms "
        f"WHERE {_LIMIT.format(20, 0.2, 'documents')} AND token NOT IN (SELECT lower(word) FROM stop)",
    ),
    "doc2idx": _with(
        _TO_DICTIONARY,
        "SELECT doc_id, coalesce(token_id, -1) AS token_id, CAST(sum(tf) AS BIGINT) AS tf "
        "FROM bow LEFT JOIN dictionary USING (token) GROUP BY 1, 2",
    ),
    "doc2bow": _with(
        _TO_DICTIONARY, "SELECT doc_id, token_id, tf FROM bow JOIN dictionary USING (token)"
    ),
    "oov_counts": _with(
        _TO_LIMITED,
        "SELECT doc_id, CAST(sum(tf) AS BIGINT) AS unknown_tf FROM bow "
        "WHERE token NOT IN (SELECT token FROM limited) GROUP BY doc_id",
    ),
    "union_corpora": _with(
        [*_CORPUS, PAGE_TOKENS, PAGE_BOW, ITEM_TOKENS, ITEM_BOW],
        "SELECT doc_id, token, tf, 'documents' AS corpus FROM bow "
        "UNION ALL SELECT doc_id, token, tf, 'pages' FROM page_bow "
        "UNION ALL SELECT doc_id, token, tf, 'benchmark' FROM item_bow",
    ),
    "idf": _with([*_TO_LIMITED, IDF], "SELECT token, df, round(idf, 6) AS idf FROM idf"),
    "tfidf_raw": _with(_TO_RAW, "SELECT doc_id, token, round(weight, 6) AS weight FROM raw"),
    "tfidf": _with(_TO_TFIDF, "SELECT doc_id, token, round(weight, 6) AS weight FROM tfidf"),
    "tfidf_matrix": _with(
        [*_TO_DICTIONARY, *_TO_TFIDF[len(_TO_LIMITED):]],
        "SELECT doc_id, token_id, round(weight, 6) AS weight FROM tfidf JOIN dictionary USING (token)",
    ),
    "top_terms": _with(
        _TO_TFIDF,
        "SELECT doc_id, CAST(rank AS INTEGER) AS rank, token, round(weight, 6) AS weight FROM (SELECT *, row_number() OVER "
        "(PARTITION BY doc_id ORDER BY weight DESC, token) AS rank FROM tfidf) AS ranked WHERE rank <= 10",
    ),
    "split_documents": """
WITH RECURSIVE lines AS (
    SELECT conv_id AS doc_id, turn, strlen(text) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n
    FROM conversations
), walk AS (
    SELECT doc_id, turn, n, CAST(0 AS BIGINT) AS segment, CAST(size AS BIGINT) AS held FROM lines WHERE n = 1
    UNION ALL
    SELECT lines.doc_id, lines.turn, lines.n,
        CASE WHEN walk.held > 500 THEN walk.segment + 1 ELSE walk.segment END,
        CASE WHEN walk.held > 500 THEN lines.size ELSE walk.held + lines.size END
    FROM walk JOIN lines ON lines.doc_id = walk.doc_id AND lines.n = walk.n + 1
)
SELECT doc_id, turn, segment FROM walk""",
    "lda_k1_topic_terms": _with(
        [*_TO_TFIDF, TOTALS],
        "SELECT CAST(0 AS INTEGER) AS topic_id, token, round((1 + coalesce(total, 0)) / "
        "((SELECT sum(total) FROM totals) + (SELECT count(*) FROM limited)), 9) AS weight "
        "FROM limited LEFT JOIN totals USING (token)",
    ),
    "lda_k1_top_terms": _with(
        [
            *_TO_DICTIONARY,
            *_TO_TFIDF[len(_TO_LIMITED):],
            TOTALS,
            (
                "shares",
                "SELECT token_id, token, (1 + coalesce(total, 0)) / ((SELECT sum(total) FROM totals) + "
                "(SELECT count(*) FROM limited)) AS weight FROM dictionary LEFT JOIN totals USING (token)",
            ),
            ("ranked", "SELECT *, row_number() OVER (ORDER BY weight DESC, token_id) AS n FROM shares"),
        ],
        "SELECT CAST(1 AS INTEGER) AS k, CAST(0 AS INTEGER) AS topic_id, CAST(n AS INTEGER) AS rank, token, "
        "round(weight, 9) AS weight FROM ranked WHERE n <= 10",
    ),
    "lda_k1_perplexity": _with(
        [*_TO_TFIDF, TOTALS],
        "SELECT CAST(1 AS INTEGER) AS k, round(-(sum(lgamma(1 + total)) + lgamma(any_value(v)) "
        "- lgamma(sum(total) + any_value(v))) / sum(total), 6) AS log_perplexity "
        "FROM totals, (SELECT CAST(count(*) AS DOUBLE) AS v FROM limited) AS vocabulary",
    ),
    "similarity_groups": _with(
        [*_TO_TFIDF, PRINTS, GROUPS], "SELECT doc_id, group_id FROM groups"
    ),
    "tfidf_similarity": _with(
        [*_TO_TFIDF, PRINTS, GROUPS, FIRSTS],
        "SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, round(sum(a.weight * b.weight), 6) AS score "
        "FROM firsts AS a JOIN firsts AS b ON a.token = b.token AND a.doc_id < b.doc_id "
        "GROUP BY 1, 2 HAVING sum(a.weight * b.weight) >= 0.7",
    ),
    "tfidf_common_word": _with(
        [
            ("marked", "SELECT doc_id, 'everywhere ' || text AS text FROM documents"),
            ("tokens", _tokens("marked", "doc_id", "text")),
            BOW,
            TERMS,
            ("limited", "SELECT * FROM terms"),
            IDF,
            RAW,
            TFIDF,
        ],
        "SELECT doc_id, token, round(weight, 6) AS weight FROM tfidf",
    ),
    "lda_share_totals": "SELECT doc_id, CAST(4 AS BIGINT) AS n_topics, CAST(1.0 AS DOUBLE) AS total FROM documents",
    "report_document_lines_k1": "SELECT doc_no, n AS line_no, CASE n WHEN 0 THEN 'Doc #' || doc_no "
    "ELSE chr(9) || '1.0 on topic #0' END AS line FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_no "
    "FROM documents) AS numbered, (VALUES (CAST(0 AS INTEGER)), (1)) AS lines(n)",
    "report_document_lines": _with(
        [
            TOKENS,
            ("of_class", "SELECT doc_id, (ascii(token) - 97) % 4 AS topic_id, count(*) AS c FROM tokens GROUP BY 1, 2"),
            ("sizes", "SELECT doc_id, count(*) AS n FROM tokens GROUP BY 1"),
            ("numbered", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_no FROM documents"),
            (
                "shares",
                "SELECT doc_no, t.topic_id, CASE WHEN n IS NULL THEN CAST(0.25 AS DOUBLE) ELSE "
                "floor(CAST(1000 AS DOUBLE) * coalesce(c, 0) / n) / CAST(1000 AS DOUBLE) END AS weight FROM numbered "
                "CROSS JOIN (VALUES (0), (1), (2), (3)) AS t(topic_id) LEFT JOIN sizes USING (doc_id) "
                "LEFT JOIN of_class ON of_class.doc_id = numbered.doc_id AND of_class.topic_id = t.topic_id",
            ),
        ],
        "SELECT doc_no, CAST(0 AS INTEGER) AS line_no, 'Doc #' || doc_no AS line FROM numbered UNION ALL "
        "SELECT doc_no, CAST(row_number() OVER (PARTITION BY doc_no ORDER BY weight, topic_id) AS INTEGER), "
        "chr(9) || CAST(weight AS VARCHAR) || ' on topic #' || topic_id FROM shares WHERE weight >= 0.01",
    ),
    "report_paths": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_no, 'Doc #' || "
    "(row_number() OVER (ORDER BY doc_id) - 1) || chr(9) || doc_id AS line FROM documents",
    "matrix_market": _with(
        [
            *_TO_DICTIONARY,
            ("numbered", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents"),
            ("body", "SELECT r, token_id + 1 AS c, tf FROM bow JOIN dictionary USING (token) JOIN numbered USING (doc_id)"),
        ],
        'SELECT r AS "row", c AS "column", r || \' \' || c || \' \' || tf AS line FROM body '
        "UNION ALL SELECT 0, 0, '%%MatrixMarket matrix coordinate integer general' "
        "UNION ALL SELECT 0, 1, (SELECT count(*) FROM documents) || ' ' || (SELECT count(*) FROM dictionary) || ' ' || "
        "(SELECT count(*) FROM body)",
    ),
    "similarity_rows": _with(
        [
            *_TO_TFIDF,
            PRINTS,
            GROUPS,
            FIRSTS,
            (
                "pairs",
                "SELECT a.doc_id AS p, b.doc_id AS q, sum(a.weight * b.weight) AS score "
                "FROM firsts AS a JOIN firsts AS b ON a.token = b.token AND a.doc_id <> b.doc_id "
                "GROUP BY 1, 2 HAVING sum(a.weight * b.weight) >= 0.7",
            ),
            ("near", "SELECT * FROM pairs UNION ALL SELECT DISTINCT group_id, group_id, 1.0 FROM groups"),
        ],
        "SELECT d.doc_id, m.doc_id AS other_id, round(near.score, 6) AS score FROM groups AS d "
        "JOIN near ON d.group_id = near.p JOIN groups AS m ON m.group_id = near.q WHERE d.doc_id % 20 = 0",
    ),
}
