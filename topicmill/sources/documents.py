"""Document sources.

A corpus is a DataFrame ``(doc_id, text)`` with one row per document, or
``(doc_id, line)`` style rows named ``(doc_id, text)`` for text files, together
with an index ``(doc_id, read_error)`` that has a row for every document.
"""

from __future__ import annotations

import bz2
import fnmatch
import io
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topicmill.session import stage_path, staged

_CHUNK = 1 << 20

# Paths that the driver holds at a time while it lists, and that one reader is given.
PATHS_PER_BATCH = 10_000

# Rows of text that a task hands on at a time.
_LINES = 10_000


def document_table(table: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Any table with a unique id and a text as ``(doc_id, text)``."""
    return table.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def table_index(docs: DataFrame) -> DataFrame:
    """Index of a document table; a null text could not be read."""
    return docs.select("doc_id", F.col("text").isNull().alias("read_error"))


@dataclass(frozen=True)
class TextCorpus:
    """Text files: ``lines`` (doc_id, text) and ``index`` (doc_id, read_error)."""

    lines: DataFrame
    index: DataFrame


def plain_path(uri: Column) -> Column:
    """The path as a user writes it: Spark reports it as an encoded URI."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def _name_fits(doc_id: Column, name_glob: str | None) -> Column:
    """The one name filter, for the index and for the lines: ``*``, ``?`` and ``[...]``
    on the file's name; all other characters, braces too, stand for themselves."""
    if name_glob is None:
        return F.lit(True)
    return F.element_at(F.split(doc_id, "/"), -1).rlike(fnmatch.translate(name_glob))


def _is_hidden(doc_id: Column, folder: str = "") -> Column:
    """Whether Spark's reader leaves the file out: below the folder it skips files and
    folders with a leading dot or underscore, and copies under way. It does so by name,
    even if the path is given."""
    below = F.substr(doc_id, F.lit(len(folder) + 1)) if folder else F.element_at(F.split(doc_id, "/"), -1)
    return F.exists(
        F.split(below, "/"),
        lambda name: name.startswith(".")
        | (name.startswith("_") & ~name.contains("="))
        | name.endswith("._COPYING_"),
    )


def _batches_of(values: Iterable, size: int) -> Iterator[list]:
    values = iter(values)
    while found := list(islice(values, size)):
        yield found


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _below(spark: SparkSession, folder: str) -> Iterator[str]:
    path, system = _hadoop_path(spark, folder)
    files = system.listFiles(path, True)
    while files.hasNext():
        yield re.sub("^file:/+", "/", files.next().getPath().toString())


def list_files(spark: SparkSession, folder: str, name_glob: str | None = None) -> DataFrame:
    """``(doc_id)``: every file below ``folder``, empty and hidden ones included.

    Spark's file sources give no row for these, so the list comes from the file
    system that Spark reads, any that Hadoop knows. The driver holds a batch of it.
    """
    path = stage_path(spark, "listing")
    spark.createDataFrame([], "doc_id string").write.parquet(path)
    for found in _batches_of(_below(spark, folder), PATHS_PER_BATCH):
        spark.createDataFrame([(f,) for f in found], "doc_id string").write.mode("append").parquet(path)
    files = spark.read.schema("doc_id string").parquet(path)
    return files.filter(_name_fits(F.col("doc_id"), name_glob))


def manifest_paths(spark: SparkSession, manifest: str) -> DataFrame:
    """``(doc_id)``: the paths in a manifest, without empty lines."""
    return (
        spark.read.text(manifest)
        .filter(F.length("value") > 0)
        .select(F.col("value").alias("doc_id"))
        .distinct()
    )


def _opened(path: str):
    """The bytes of a file, bz2 undone, or None if the file system is not one that
    Python tasks can open."""
    try:
        if "://" in path:
            system, inner = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
        else:
            system, inner = pafs.LocalFileSystem(), path.removeprefix("file:")
    except (ValueError, OSError, NotImplementedError):
        return None
    stream = system.open_input_stream(inner, compression=None)
    return bz2.BZ2File(stream) if path.endswith(".bz2") else stream


def _check(path: str) -> bool | None:
    """Whether reading the file as UTF-8 text fails; reads it in pieces. None: unknown."""
    try:
        stream = _opened(path)
        if stream is None:
            return None
        with io.TextIOWrapper(io.BufferedReader(stream, _CHUNK), encoding="utf-8") as text:
            while text.read(_CHUNK):
                pass
        return False
    except (OSError, EOFError, ValueError):
        return True


def _check_files(batches):
    for batch in batches:
        flags = [_check(path) for path in batch["doc_id"]]
        yield batch.assign(read_error=pd.array(flags, dtype="boolean"))


def read_errors(paths: DataFrame) -> DataFrame:
    """``(doc_id, read_error)``; null if tasks cannot open that file system themselves.

    Spark's reader takes a bz2 file with a damaged start for an empty one and can only
    fail on, or silently skip, other damage, so each file is checked by itself. Paths
    are spread, as files differ in size.
    """
    return _spread(paths).mapInPandas(_check_files, "doc_id string, read_error boolean")


def _spread(paths: DataFrame) -> DataFrame:
    spark = paths.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(max(spark.sparkContext.defaultParallelism, partitions))


def _numbered_lines(path: str) -> Iterator[tuple]:
    """The lines of a file that can be read; damage ends them, as it ends Spark's."""
    try:
        stream = _opened(path)
        if stream is None:
            raise RuntimeError(f"tasks cannot open the hidden file {path}")
        reader = io.TextIOWrapper(io.BufferedReader(stream, _CHUNK), encoding="utf-8", errors="replace")
        for place, line in enumerate(reader):
            yield path, 0, place, line.removesuffix("\n")
    except (OSError, EOFError):
        return


def _read_in_tasks(batches):
    columns = ["doc_id", "split_start", "place", "text"]
    for batch in batches:
        for path in batch["doc_id"]:
            for rows in _batches_of(_numbered_lines(path), _LINES):
                yield pd.DataFrame(rows, columns=columns)


def read_hidden(paths: DataFrame) -> DataFrame:
    """The columns of ``read_lines`` for files whose names Spark's reader refuses."""
    return _spread(paths.select("doc_id")).mapInPandas(
        _read_in_tasks, "doc_id string, split_start bigint, place bigint, text string"
    )


def read_lines(
    spark: SparkSession, paths: str | list[str], name_glob: str | None = None, damaged: bool = False
) -> DataFrame:
    """``(doc_id, split_start, place, text)`` of text files below the given paths.

    bz2 is decoded by extension. A line's place is its order within the file split
    that starts at ``split_start``. A file that cannot be read to its end fails the job;
    with ``damaged`` its lines up to there are kept.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", str(damaged).lower())
    doc_id = plain_path(F.col("_metadata.file_path"))
    found = reader.text(paths)
    if name_glob is not None:
        found = found.filter(_name_fits(doc_id, name_glob))
    return found.select(
        doc_id.alias("doc_id"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
    )


def _index(paths: DataFrame, check: bool) -> DataFrame:
    if check:
        return staged(read_errors(paths), "index")
    return paths.select("doc_id", F.lit(None).cast("boolean").alias("read_error"))


def _has_damage(index: DataFrame, check: bool) -> bool:
    return check and not index.filter("read_error").isEmpty()


def _with_hidden(lines: DataFrame, hidden: DataFrame) -> DataFrame:
    return lines if hidden.isEmpty() else lines.unionByName(read_hidden(hidden))


def folder_corpus(
    spark: SparkSession, folder: str, name_glob: str | None = None, check: bool = True
) -> TextCorpus:
    """Every file below ``folder`` is a document; its path is the id. ``check``
    reads each file once more to flag damaged ones, of which the lines before the damage
    stay; without it the flag is null and a damaged file fails the job."""
    paths = list_files(spark, folder, name_glob)
    index = _index(paths, check)
    base = re.sub("^file:/+", "/", folder).rstrip("/")
    root, system = _hadoop_path(spark, folder)
    qualified = re.sub("^file:/+", "/", system.makeQualified(root).toString()).rstrip("/")
    hidden = paths.filter(_is_hidden(F.col("doc_id"), qualified))
    lines = read_lines(spark, _literal(base), name_glob, _has_damage(index, check))
    return TextCorpus(_with_hidden(lines, hidden), index)


def _literal(path: str) -> str:
    """The path for a reader that would take some characters for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _present(spark: SparkSession, paths: list[str]) -> list[str]:
    def is_file(name: str) -> bool:
        path, system = _hadoop_path(spark, name)
        return system.exists(path) and system.getFileStatus(path).isFile()

    with ThreadPoolExecutor(16) as threads:
        return [p for p, found in zip(paths, threads.map(is_file, paths)) if found]


def manifest_corpus(
    spark: SparkSession, manifest: str, root: str | None = None, check: bool = True
) -> TextCorpus:
    """The files named in ``manifest``, a missing one with a read error.

    With ``root``, a folder that holds them all, the paths stay in a table: the
    folder is scanned and lines of other files are dropped by a semi join.
    Without it readers are given the paths, ``PATHS_PER_BATCH`` each. As in any scan
    of files the driver then holds the paths; the text never passes through it.
    """
    paths = staged(manifest_paths(spark, manifest), "manifest")
    index = _index(paths, check)
    damaged = _has_damage(index, check)
    doc_id = F.col("doc_id")
    if root is not None:
        base = re.sub("^file:/+", "/", root).rstrip("/")
        hidden = paths.filter(_is_hidden(doc_id, base))
        lines = read_lines(spark, _literal(base), None, damaged).join(paths, "doc_id", "left_semi")
        return TextCorpus(_with_hidden(lines, hidden), index)
    named = (row["doc_id"] for row in paths.filter(~_is_hidden(doc_id)).toLocalIterator())
    readers = []
    for batch in _batches_of(named, PATHS_PER_BATCH):
        present = _present(spark, batch)
        if present:
            readers.append(read_lines(spark, [_literal(p) for p in present], None, damaged))
    none = spark.createDataFrame([], "doc_id string, split_start bigint, place bigint, text string")
    lines = reduce(DataFrame.unionByName, readers, none)
    return TextCorpus(_with_hidden(lines, paths.filter(_is_hidden(doc_id))), index)
