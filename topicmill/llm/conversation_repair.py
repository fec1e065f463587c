"""Repair of conversation structure by the cheapest edits, with an audit of them.

The rows of a conversation, by turn, are kept, reroled, deleted or preceded by inserted turns
until their role initials read ``(s?(ua)+)?``. The state after a prefix of edits follows from
its letters, so a dynamic program over four states finds the least cost and, of audits of that
cost, the least in ASCII order. Prefixes are linked nodes (``edit_prefixes``) that are compared
by their longest common prefix.

Rows are dealt by ranges of (conversation, turn), so a conversation may span tasks. Each is cut
into blocks of bounded size, and a block gives for each state before it and each after it the
cheapest edits. A second pass chains the blocks of a conversation without their texts; a third
streams the texts of its blocks in order. What one task holds of a conversation is its audit and
those of its blocks; only the hash over a repaired conversation is taken by one task, row by row.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.llm.common import NO_ID, written
from topicmill.llm.edit_prefixes import Prefixes

#: Rows, and characters, after which a block ends.
BLOCK_ROWS, BLOCK_CHARACTERS = 4096, 4_000_000

BLANKS = " \t\n\x0b\x0c\r"
#: Fixed costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States by the last initial: none, s, u, a. A conversation may end in those of ``ENDS``.
STATES, ENDS = range(4), (0, 3)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_MADE = {0: 2, 1: 2, 2: 3, 3: 2}  # after a turn reroled or inserted as the state asks
_ROLES = {2: "user", 3: "assistant"}
_LEGAL = {"su", "ua", "au"}

Cells = list[tuple[int, int] | None]  # cost and node of each state that can be reached

_PATHS = "array<struct<entry: int, exit: int, cost: long, audit: string>>"
BLOCKS = (
    "conv long, block long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
    f"low string, high string, turns long, paths {_PATHS}, roles array<string>, texts array<string>"
)
CHOSEN = (
    "conv long, block long, entry int, edits string, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string"
)
AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)
TURNS = "conv_id long, number long, edit string, role string, text string"


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults by ``crc32(conv_id:turn) % 20``.

    0 drops a row, 1 empties its text, 2 takes its ``.``, ``!`` and ``?`` away, 3 repeats it, 4
    makes it the user's. A null id, turn, role or text counts as one space.
    """
    kind = F.crc32(F.concat_ws(":", _or_space("conv_id"), _or_space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"), kind.alias("kind"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        rows.filter("kind <> 0")
        .select("conv_id", "turn", role.alias("role"), text.otherwise(F.col("text")).alias("text"), copies.alias("copy"))
        .drop("copy")
    )


def _inserted(cells: Cells, nodes: Prefixes) -> Cells:
    """Turns inserted before the next row where that pays."""
    cells, moved = list(cells), True
    while moved:
        moved = False
        for state in STATES:
            if cells[state] is not None:
                cost, node = cells[state]
                moved |= _offer(cells, _MADE[state], cost + INSERT, node, "I", nodes)
    return cells


def _offer(cells: Cells, state: int, cost: int, node: int, letter: str, nodes: Prefixes) -> bool:
    """Put ``node`` and one letter into a cell if that is cheaper, or as cheap and less."""
    old = cells[state]
    if old is not None:
        if cost > old[0]:
            return False
        if cost == old[0]:
            if nodes.parent[old[1]] == node and nodes.piece[old[1]] == letter:
                return False
            new = nodes.add(node, letter)
            if not nodes.less(new, old[1]):
                return False
            cells[state] = (cost, new)
            return True
    cells[state] = (cost, nodes.add(node, letter))
    return True


def best_edits(entry: int, rows: Iterable[tuple[str, str | None]]) -> list[tuple[int, int, str]]:
    """State after, cost and audit of the cheapest edits of (initial, fault) rows from one state."""
    nodes = Prefixes()
    cells: Cells = [(0, 0) if state == entry else None for state in STATES]
    for initial, fault in rows:
        before, cells = _inserted(cells, nodes), [None] * 4
        kept = _KEPT.get(initial, {})
        extra = TRUNCATED * (fault == "truncated")
        for state in STATES:
            if before[state] is None:
                continue
            cost, node = before[state]
            _offer(cells, state, cost + DELETE, node, "D", nodes)
            if fault not in ("blank", "duplicate"):
                if state in kept:
                    _offer(cells, kept[state], cost + extra, node, "K", nodes)
                _offer(cells, _MADE[state], cost + REROLE + extra, node, "R", nodes)
    return [(state, cell[0], nodes.text(cell[1])) for state, cell in enumerate(cells) if cell is not None]


def chained(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Least cost over the paths (entry, exit, cost, audit) of blocks in order, and the state
    before each block with its edits; those after the last row belong to the last block."""
    nodes = Prefixes()
    cells: Cells = [(0, 0), None, None, None]
    states = {0: 0}  # of each node
    for paths in blocks:
        before, cells = cells, [None] * 4
        for entry, after, cost, audit in paths:
            if before[entry] is not None:
                _offer(cells, after, before[entry][0] + cost, before[entry][1], audit, nodes)
        states.update((cell[1], state) for state, cell in enumerate(cells) if cell is not None)
    cells = _inserted(cells, nodes)
    cost, node = None, 0
    for state in ENDS:
        if cells[state] is not None:
            new = cells[state]
            if cost is None or new[0] < cost or (new[0] == cost and nodes.less(new[1], node)):
                cost, node = new
    steps, at = [], node
    while at:
        steps.append((states.get(nodes.parent[at], 0), nodes.piece[at]))
        at = nodes.parent[at]
    steps.reverse()
    whole = steps[: len(blocks)]
    if steps[len(blocks) :]:
        entry, edits = whole[-1]
        whole[-1] = (entry, edits + "".join(piece for _, piece in steps[len(blocks) :]))
    return cost, whole


def applied(entry: int, edits: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Letter, role and text of each turn that stays or is inserted."""
    state, turns = entry, iter(turns)
    for letter in edits:
        if letter == "I":
            state = _MADE[state]
            yield letter, _ROLES[state], ""
            continue
        role, text = next(turns)
        if letter == "R":
            state = _MADE[state]
            yield letter, _ROLES[state], text
        elif letter == "K":
            state = _KEPT[role[0]][state]
            yield letter, role, text


def _fault(text: str, repeated: bool) -> str | None:
    bare = text.rstrip(BLANKS)
    return "blank" if not bare else "duplicate" if repeated else None if bare[-1] in ".!?" else "truncated"


def _block(conv: int, number: int, rows: list[tuple], first: bool) -> tuple:
    """A row of ``BLOCKS``. Only a block that is surely a conversation's first has one entry."""
    roles, texts = [r[2] for r in rows], [r[3] for r in rows]
    faults = [_fault(r[3], r[4]) for r in rows]
    initials = [role[:1] for role in roles]
    illegal = sum(a + b not in _LEGAL for a, b in itertools.pairwise(initials))
    turns = sorted({int(r[1]) for r in rows if r[1] is not None})
    paths = [
        {"entry": entry, "exit": after, "cost": cost, "audit": audit}
        for entry in ((0,) if first else STATES)
        for after, cost, audit in best_edits(entry, zip(initials, faults))
    ]
    counts = [faults.count(kind) for kind in ("blank", "duplicate", "truncated")]
    ends = (str(turns[0]), str(turns[-1])) if turns else (None, None)
    return conv, number, *counts, illegal, initials[0], initials[-1], *ends, len(turns), paths, roles, texts


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c] for c in batch.columns))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a range, in order, as blocks."""
    from pyspark import TaskContext

    names = [column.split()[0] for column in re.sub("array<struct.*?>>|array<string>", "x", BLOCKS).split(", ")]
    number = TaskContext.get().partitionId() << 32
    known_start = False
    found = []
    for conv, rows in itertools.groupby(_rows(batches), key=lambda row: row[0]):
        first = known_start  # the first conversation of a range may begin in the range before
        held, size = [], 0
        for row in rows:
            held.append(row)
            size += len(row[3])
            if len(held) == BLOCK_ROWS or size >= BLOCK_CHARACTERS:
                found.append(_block(int(conv), number, held, first))
                number, held, size, first = number + 1, [], 0, False
                yield pd.DataFrame(found, columns=names)
                found = []
        if held:
            found.append(_block(int(conv), number, held, first))
            number += 1
        known_start = True
        if len(found) >= 1000:
            yield pd.DataFrame(found, columns=names)
            found = []
    yield pd.DataFrame(found, columns=names)


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits of each block; the first of a conversation carries its counts and its audit."""
    names = [column.split()[0] for column in CHOSEN.split(", ")]
    found = []
    for conv, group in itertools.groupby(_rows(batches), key=lambda row: row[0]):
        blocks = list(group)
        cost, steps = chained([[(p["entry"], p["exit"], p["cost"], p["audit"]) for p in block[11]] for block in blocks])
        counts = [sum(block[i] for block in blocks) for i in range(2, 6)]
        counts[3] += sum(a[7] + b[6] not in _LEGAL for a, b in itertools.pairwise(blocks))
        dated = [block for block in blocks if block[10]]
        gaps = 0
        if dated:
            turns = sum(b[10] for b in dated) - sum(int(a[9]) == int(b[8]) for a, b in itertools.pairwise(dated))
            gaps = int(dated[-1][9]) - int(dated[0][8]) + 1 - int(turns)
        whole = (gaps, *map(int, counts), cost, "".join(edits for _, edits in steps))
        for n, (block, (entry, edits)) in enumerate(zip(blocks, steps)):
            found.append((int(conv), int(block[1]), entry, edits, *(whole if n == 0 else [None] * 7)))
        if len(found) >= 1000:
            yield _whole_numbers(found, names)
            found = []
    yield _whole_numbers(found, names)


def _whole_numbers(found: list[tuple], names: list[str]) -> pd.DataFrame:
    numbers = {name: "Int64" for name in names if name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return pd.DataFrame(found, columns=names).astype(numbers)


def _in_order(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """All that the last pass needs, sorted by conversation: the id alone, then for each block
    its edits and its turns."""
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv")
    placed = written(
        rows.select(
            conv,
            F.col("turn").cast("long").alias("turn"),
            F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
            F.monotonically_increasing_id().alias("place"),
        ).fillna(" ", ["role", "text"]),
        "turns",
    )
    # the first of equal turns; joined by place, so a text of half the rows is dealt evenly
    text = F.sha2(F.concat_ws("\0", F.length("role"), "role", "text"), 256)
    first = placed.groupBy("conv", text.alias("same")).agg(F.min(F.struct("turn", "place")).alias("first"))
    first = first.select(F.col("first.place").alias("place"), F.lit(False).alias("repeated"))
    marked = placed.join(first, "place", "left").select(
        "conv", "turn", "role", "text", F.coalesce("repeated", F.lit(True)).alias("repeated"), "place"
    )
    order = ["conv", "turn", "role", "text", "place"]
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    # as text, since a column with nulls would come to pandas as floating point
    ranged = ranged.drop("place").withColumn("turn", F.col("turn").cast("string"))
    blocks = written(ranged.mapInPandas(_blocks, BLOCKS), "blocks")
    chosen = written(
        blocks.drop("roles", "texts").repartition("conv").sortWithinPartitions("conv", "block").mapInPandas(_choose, CHOSEN),
        "edits",
    )
    alone = ids.select(conv).distinct().select("conv", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("part"))
    edits = chosen.withColumn("part", F.lit(1))
    turns = blocks.select("conv", "block", F.lit(2).alias("part"), "roles", "texts")
    joined = alone.unionByName(edits, allowMissingColumns=True).unionByName(turns, allowMissingColumns=True)
    columns = ["conv", "block", "part", *[c.split()[0] for c in CHOSEN.split(", ")[2:]], "roles", "texts"]
    return joined.select(*columns).repartition("conv").sortWithinPartitions("conv", "block", "part")


def repaired(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The turns of every repaired conversation: ``TURNS``, numbered from 0, with the edit's letter.

    See ``audits`` for what ``rows`` may hold.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [column.split()[0] for column in TURNS.split(", ")]
        conv, number = None, 0
        for row in _rows(batches):
            if row[2] == 1:
                number = number if row[0] == conv else 0
                conv, entry, edits = row[0], int(row[3]), row[4]
            elif row[2] == 2:
                turns = list(applied(entry, edits, zip(row[12], row[13])))
                yield pd.DataFrame([(conv, number + n, *turn) for n, turn in enumerate(turns)], columns=names)
                number += len(turns)

    found = _in_order(rows, rows if ids is None else ids).mapInPandas(run, TURNS)
    return found.withColumn("conv_id", F.nullif("conv_id", F.lit(NO_ID)))


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``AUDITS`` of each conversation: its faults, the cheapest edits and the hash of what they leave.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored, and a null
    role or text is one space. Rows go by turn, nulls first; rows of one turn by role and text. A null
    ``conv_id`` is a conversation of its own. Every id of ``ids`` has a row, those without ``rows``
    with zeros, an empty audit and the hash of nothing; an empty table has none. Conversations may
    have any number of rows, texts any length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [column.split()[0] for column in AUDITS.split(", ")]
        found = []
        for conv, group in itertools.groupby(_rows(batches), key=lambda row: row[0]):
            counts, digest, between = (0, 0, 0, 0, 0, 0, ""), hashlib.sha256(), b""
            for row in group:
                if row[2] == 1:
                    entry, edits = int(row[3]), row[4]
                    if not pd.isna(row[5]):
                        counts = (*map(int, row[5:11]), row[11])
                elif row[2] == 2:
                    for _, role, text in applied(entry, edits, zip(row[12], row[13])):
                        digest.update(between + f"{role}:{text}".encode())
                        between = b"\n"
            found.append((int(conv), *counts, digest.hexdigest()))
            if len(found) >= 10_000:
                yield pd.DataFrame(found, columns=names)
                found = []
        yield pd.DataFrame(found, columns=names)

    found = _in_order(rows, rows if ids is None else ids).mapInPandas(run, AUDITS)
    return found.withColumn("conv_id", F.nullif("conv_id", F.lit(NO_ID)))
