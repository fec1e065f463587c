"""Join rows with a table of words without sending a frequent word's rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicmill.session import staged

#: Bytes of keys and numbers that are broadcast at most.
HEAD_BYTES = 8 << 20
#: Longer words are not broadcast apart from the whole table; none of them is frequent in a text of words.
LONGEST = 64
#: Of a row beside its key: the numbers of a dictionary and the table's own overhead.
_ROW_BYTES = 64


def table_bytes(words: DataFrame, key: str) -> int:
    """An upper bound of what a table of a key and a few numbers takes."""
    size = F.octet_length(F.col(key).cast("string")) + F.lit(_ROW_BYTES)
    return words.agg(F.sum(size)).first()[0] or 0


def frequent_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys with most rows, as many as ``HEAD_BYTES`` holds. Keys that ``rows`` has but
    the words lack count as well: a word above the frequency limits is the hottest of all."""
    short = rows.select(key).filter(F.octet_length(F.col(key).cast("string")) <= LONGEST)
    counted = short.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    most = max(HEAD_BYTES // (LONGEST + _ROW_BYTES), 1)
    return counted.orderBy(F.desc("_rows"), key).limit(most).select(key)


def join_words(
    rows: DataFrame, words: DataFrame, key: str, how: str = "inner", written: bool = False
) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) with ``words``, a table of a unique key and numbers.

    A table of at most ``HEAD_BYTES`` goes to all tasks, and the rows are not shuffled. Beyond,
    the rows are written, unless they are read from a ``written`` table, and their most frequent keys are met by a broadcast of that many
    bytes; what is left is shuffled by key. None of it is more frequent than the last key of
    the broadcast, so no task gets a share of the rows, whatever adaptive execution does.
    """
    if table_bytes(words, key) <= HEAD_BYTES:
        return rows.join(F.broadcast(words), key, how)
    rows = rows if written else staged(rows, "looked-up")
    head = staged(frequent_keys(rows, key), "frequent")
    frequent = rows.join(F.broadcast(staged(head.join(words, key, how), "frequent-words")), key)
    rare = rows.join(F.broadcast(head), key, "left_anti").join(words.hint("merge"), key, how)
    return frequent.unionByName(rare)
