"""The jobs: topics for several counts, topics of new documents, document similarity, and
a prepared corpus with documents added.

Every stage is a table below the output folder. A stage is used again when the
same parameters made it, as its path carries a hash of them; the unfiltered
dictionary and bag of words depend on the corpus alone, so new limits do not
count the corpus again. Tables that a job stages elsewhere go when it ends.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicmill.functions import defaults
from topicmill.operators import corpus, counts, dictionary, lda, lsi, similarity, splitting, tfidf
from topicmill.operators.numbering import number_by
from topicmill.session import remove_folder, stages_of_job
from topicmill.sinks import reports, tables
from topicmill.sources.documents import TextCorpus, table_index
from topicmill.sources.stages import saved_table, saved_topic_counts, saved_topics, saved_vectors


@dataclass(frozen=True)
class Corpus:
    """What the jobs need of a corpus. ``name`` stands for its content in stage
    paths: give a new name when the content changes."""

    name: str
    bow: DataFrame
    index: DataFrame

    @staticmethod
    def from_table(name: str, docs: DataFrame) -> Corpus:
        return Corpus(name, counts.bag_of_words(docs), table_index(docs))

    @staticmethod
    def from_text(name: str, text: TextCorpus, split_bytes: int | None = None) -> Corpus:
        """Text files; with ``split_bytes`` each segment of a file, cut after the line that
        goes beyond that size, is a document of its own, ``path#segment``."""
        if split_bytes is None:
            return Corpus(name, counts.bag_of_words_from_lines(text.lines), text.index)
        numbered = splitting.number_lines(text.lines)
        cut = splitting.split_documents(numbered, "line_no", split_bytes, newline_bytes=1)
        segments = cut.select("doc_id", "segment").distinct()
        # A file without lines is one empty document.
        parts = text.index.join(segments, "doc_id", "left").withColumn("segment", F.coalesce("segment", F.lit(0)))
        index = splitting.as_documents(parts).select("doc_id", "read_error")
        return Corpus(name, counts.bag_of_words_from_lines(splitting.as_documents(cut)), index)


@dataclass(frozen=True)
class Limits:
    no_below: int = defaults.NO_BELOW
    no_above: float = defaults.NO_ABOVE
    stop: DataFrame | None = None
    keep: DataFrame | None = None


class Results(dict[str, DataFrame]):
    """The tables of a job, by name, and the folder that holds its own stages."""

    def __init__(self, folder: str, **found: DataFrame):
        super().__init__(found)
        self.folder = folder


@dataclass(frozen=True)
class Prepared:
    """Stages shared by both jobs."""

    folder: str
    index: DataFrame
    num_docs: int
    dictionary: DataFrame
    vectors: tfidf.VectorTable


def _list_hash(words: DataFrame | None) -> str | None:
    """Order-free hash of a word list, computed where the list is."""
    if words is None:
        return None
    row = words.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("word")).alias("x")
    ).first()
    return f"{row['n']}-{row['x']}"


def _key(**parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:16]


def _stage(spark: SparkSession, path: str, build) -> DataFrame:
    found = saved_table(spark, path)
    return tables.write_table(build(), path) if found is None else found


def _corpus_folder(outdir: str, name: str) -> str:
    return f"{outdir}/corpus-{_key(name=name)}"


def _limits_folder(limits: Limits) -> str:
    return "limits-" + _key(
        no_below=limits.no_below,
        no_above=limits.no_above,
        stop=_list_hash(limits.stop),
        keep=_list_hash(limits.keep),
    )


def prepare(source: Corpus, outdir: str, limits: Limits, clean: bool = False) -> Prepared:
    """Index, bag of words, dictionaries and TF-IDF matrix. ``clean`` first removes all that
    any run wrote for this corpus: every limit's matrix, models, results and reports."""
    spark = source.bow.sparkSession
    base = _corpus_folder(outdir, source.name)
    if clean:
        remove_folder(spark, base)

    def again(path, build):
        return _stage(spark, path, build)

    index = again(f"{base}/index", lambda: reports.number_documents(source.index))
    num_docs = index.count()
    bow = again(f"{base}/bag_of_words", lambda: source.bow)
    unfiltered = again(f"{base}/dictionary_unfiltered", lambda: dictionary.build_dictionary(bow))
    again(f"{base}/stats", lambda: counts.stats_from_terms(unfiltered, num_docs))

    folder = f"{base}/{_limits_folder(limits)}"
    words = again(
        f"{folder}/dictionary",
        lambda: dictionary.renumber(
            dictionary.filter_dictionary(
                unfiltered, num_docs, limits.no_below, limits.no_above, limits.stop, limits.keep
            )
        ),
    )
    again(f"{folder}/corpus", lambda: corpus.doc2bow(bow, words))
    again(f"{folder}/tfidf_model", lambda: tfidf.fit_idf(words, num_docs))
    path = f"{folder}/tfidf_corpus"
    vectors = saved_vectors(spark, path, dictionary.id_space(words))
    if vectors is None:
        vectors = tfidf.vectors_from_bow(bow, words, num_docs, path, index)
    return Prepared(folder, index, num_docs, words, vectors)


def refresh(earlier: str, fresh: Corpus, name: str, outdir: str, limits: Limits = Limits()) -> Corpus:
    """The corpus ``name``: that of the name ``earlier``, prepared in ``outdir`` with the same
    limits, and the documents of ``fresh``. Their ids must be new.

    Its stages are made from those of ``earlier``, whose text is not read and whose stages
    stay. Known words and documents keep their numbers. Limits and idf follow the new counts,
    so weights are computed again from the kept numbers; of the earlier bag of words only the
    words are looked up that the limits now admit. Broken off, it goes on where it stopped.
    """
    spark = fresh.bow.sparkSession
    was, base, part = _corpus_folder(outdir, earlier), _corpus_folder(outdir, name), _limits_folder(limits)

    def old(path: str) -> DataFrame:
        found = saved_table(spark, f"{was}/{path}")
        if found is None:
            raise ValueError(f"{earlier} has no finished {path} in {outdir}")
        return found

    def stage(path: str, build) -> DataFrame:
        return _stage(spark, f"{base}/{path}", build)

    with stages_of_job(spark):
        old_index, old_words, old_bow = old("index"), old(f"{part}/dictionary"), old("bag_of_words")
        if not fresh.index.join(old_index, "doc_id", "left_semi").isEmpty():
            raise ValueError("some documents are in the earlier corpus already")
        index = stage(
            "index",
            lambda: old_index.unionByName(
                number_by(fresh.index, "doc_id", "doc_no", first=old_index.count()).select(*old_index.columns)
            ),
        )
        num_docs = index.count()
        more = stage("fresh_bag_of_words", lambda: fresh.bow)
        bow = stage("bag_of_words", lambda: old_bow.unionByName(more.select(*old_bow.columns)))
        unfiltered = stage(
            "dictionary_unfiltered",
            lambda: dictionary.merge_dictionaries(old("dictionary_unfiltered"), counts.term_statistics(more)),
        )
        stage("stats", lambda: counts.stats_from_terms(unfiltered, num_docs))
        in_limits = dictionary.filter_dictionary(
            unfiltered, num_docs, limits.no_below, limits.no_above, limits.stop, limits.keep
        )
        words = stage(f"{part}/dictionary", lambda: dictionary.keep_ids(in_limits, old_words))
        admitted = words.join(old_words.select("token"), "token", "left_anti")
        numbers = stage(
            f"{part}/corpus",
            lambda: old(f"{part}/corpus")
            .join(words.select("token_id"), "token_id", "left_semi")
            .unionByName(corpus.doc2bow(old_bow, admitted))
            .unionByName(corpus.doc2bow(more, words)),
        )
        idf = stage(f"{part}/tfidf_model", lambda: tfidf.fit_idf(words, num_docs))
        path = f"{base}/{part}/tfidf_corpus"
        if saved_table(spark, path) is None:
            weights = numbers.join(idf.select("token_id", "idf"), "token_id").select(
                "doc_id", "token_id", (F.col("tf") * F.col("idf")).alias("weight")
            )
            tfidf.vectors_from_weights(weights, dictionary.id_space(words), path, index, scale=True)
    return Corpus(name, bow, index.select("doc_id", "read_error"))


def compute_topics(
    source: Corpus,
    outdir: str,
    limits: Limits = Limits(),
    topic_counts: Iterable[int | str] = defaults.TOPIC_COUNTS,
    terms_per_topic: int = defaults.TERMS_PER_TOPIC,
    seed: int = 42,
    clean: bool = False,
    passes: int = 1,
    batch_documents: int = lda.BATCH_DOCUMENTS,
) -> Results:
    """Topics for each count: models, tables with a column ``k`` and text reports.

    Every document is read ``passes`` times, with an update for every ``batch_documents``.
    Models that the same parameters made are loaded, not fitted again.
    """
    with stages_of_job(source.bow.sparkSession):
        ready = prepare(source, outdir, limits, clean)
        counts = sorted({int(k) for k in topic_counts})
        folder = f"{ready.folder}/topics-" + _key(
            counts=counts, terms=terms_per_topic, seed=seed, passes=passes, batch_documents=batch_documents
        )
        saved = saved_topics(source.bow.sparkSession, folder, counts)
        if saved is None:
            models = lda.fit_sweep(ready.vectors, counts, ready.num_docs, seed, passes, batch_documents)
            for model in models:
                tables.write_topic_model(model, f"{folder}/lda_model/k={model.k}")
        else:
            models = lda.saved_models(ready.vectors, saved)
        return _topic_results(ready, models, folder, terms_per_topic)


def _topic_results(ready: Prepared, models: list[lda.TopicModel], folder: str, terms_per_topic: int) -> Results:
    terms = tables.write_table(
        lda.sweep_topic_terms(models, ready.dictionary, terms_per_topic),
        f"{folder}/topic_terms",
        "k",
    )
    shares = tables.write_table(
        lda.sweep_doc_topics(models, ready.index), f"{folder}/doc_topics", "k"
    )
    perplexity = tables.write_table(lda.sweep_perplexity(models), f"{folder}/perplexity")
    for model in models:
        report = f"{folder}/reports/{model.k}_TF-IDF"
        one = F.col("k") == model.k
        reports.write_topics(terms.filter(one), f"{report}/topics.txt")
        reports.write_document_topics(
            shares.filter(one), ready.index, f"{report}/doc_id_to_topic.txt"
        )
    reports.write_document_paths(ready.index, f"{folder}/reports/doc_id_to_path.txt")
    return Results(
        folder,
        index=ready.index,
        dictionary=ready.dictionary,
        topic_terms=terms,
        doc_topics=shares,
        perplexity=perplexity,
    )


def infer_topics(
    source: Corpus, folder: str, outdir: str, min_weight: float = defaults.MIN_TOPIC_WEIGHT
) -> Results:
    """Topics of documents that the models in ``folder``, the folder of an earlier
    ``compute_topics``, have not seen.

    Dictionary and idf are those of the earlier corpus; unknown words count as absent. All
    models read a document once. Nothing of the earlier run changes.
    """
    spark = source.bow.sparkSession
    limits = folder.rstrip("/").rsplit("/", 1)[0]
    with stages_of_job(spark):
        words = spark.read.parquet(f"{limits}/dictionary")
        num_docs = spark.read.parquet(f"{limits.rsplit('/', 1)[0]}/stats").first()["num_docs"]
        counts = saved_topic_counts(spark, folder)
        parts = saved_topics(spark, folder, counts)
        if not parts:
            raise ValueError(f"{folder} has no finished topic models")
        target = f"{outdir}/topics-of-{_key(name=source.name, folder=folder, min_weight=min_weight)}"
        index = tables.write_table(reports.number_documents(source.index), f"{target}/index")
        vectors = tfidf.vectors_from_bow(source.bow, words, num_docs, f"{target}/tfidf_corpus", index)
        models = lda.saved_models(vectors, parts)
        shares = lda.sweep_doc_topics(models, index, min_weight)
        return Results(target, index=index, doc_topics=tables.write_table(shares, f"{target}/doc_topics", "k"))


def compute_similarity(
    source: Corpus,
    outdir: str,
    limits: Limits = Limits(),
    dimensions: int = defaults.LATENT_DIMENSIONS,
    threshold: float = 0.5,
    seed: int = 42,
    clean: bool = False,
) -> Results:
    """Cosine among documents in the latent space, at or above ``threshold``."""
    spark = source.bow.sparkSession
    with stages_of_job(spark):
        ready = prepare(source, outdir, limits, clean)
        dealt = lsi.deal(ready.vectors)
        space = lsi.fit_lsi(dealt, ready.num_docs, dimensions, seed=seed)
        folder = f"{ready.folder}/similarity-" + _key(k=dimensions, threshold=threshold, seed=seed)
        values = tables.write_table(lsi.singular_values(spark, space), f"{folder}/singular_values")
        vectors = tables.write_table(lsi.project(dealt, space), f"{folder}/doc_vectors")
        groups = similarity.copy_groups(ready.vectors.rows())
        found = similarity.similar_in_space(vectors, groups, threshold)
        return Results(
            folder,
            singular_values=values,
            doc_vectors=vectors,
            pairs=tables.write_table(found.pairs, f"{folder}/pairs"),
            groups=tables.write_table(found.groups, f"{folder}/groups"),
        )
