"""Conversation audits against a search of all edit strings and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from topicmill.llm import conversation_repair
from topicmill.llm.edit_prefixes import Prefixes

SCHEMA = "conv_id long, turn long, role string, text string, block long, place string"
GOAL = re.compile("(s?(ua)+)?")


def damage(rows):
    found = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return found


def faults(turns):
    found, seen = [], set()
    for role, text in turns:
        marks = re.findall("[^\x20\x09-\x0d]", text)
        kind = "blank" if not marks else "duplicate" if (role, text) in seen else None if marks[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append(kind)
    return found


def plain(turns, marks):
    """Least (cost, audit, repaired) by strings alone: cheapest per place and role initials' state."""
    best = {(0, ""): (0, "", [])}  # initials so far, shortened to what still matters

    def short(initials):
        return initials[:1] if len(initials) < 2 else initials[-1]

    def fits(initials):
        return GOAL.fullmatch(initials) or GOAL.fullmatch(initials + "a") or GOAL.fullmatch(initials + "ua")

    found = {"": (0, "", [])}
    for at in range(len(turns) + 1):
        for _ in range(6):  # inserts
            for initials, (cost, audit, kept) in list(found.items()):
                for role in ("user", "assistant"):
                    offer(found, fits, short, initials + role[0], (cost + 2, audit + "I", kept + [(role, "")]))
        if at == len(turns):
            break
        (role, text), mark = turns[at], marks[at]
        after = {}
        for initials, (cost, audit, kept) in found.items():
            offer(after, fits, short, initials, (cost + 3, audit + "D", kept))
            if mark not in ("blank", "duplicate"):
                more = cost + (mark == "truncated")
                offer(after, fits, short, initials + (role[:1] or "?"), (more, audit + "K", kept + [(role, text)]))
                for other in ("user", "assistant"):
                    offer(after, fits, short, initials + other[0], (more + 2, audit + "R", kept + [(other, text)]))
        found = after
    ends = [v for k, v in found.items() if GOAL.fullmatch(k)]
    return min(ends, key=lambda v: v[:2])


def offer(found, fits, short, initials, value):
    if fits(initials):
        initials = initials if len(initials) < 4 else initials[:1] * (initials[0] == "s") + ("uaua" if initials[-1] == "a" else "uau")
        if initials not in found or value[:2] < found[initials][:2]:
            found[initials] = value


def expected(rows):
    original = {r[0] for r in rows}
    found = {}
    for conv in original:
        mine = [r for r in damage(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [(r[2], r[3]) for r in mine]
        marks = faults(turns)
        dated = [r[1] for r in mine if r[1] is not None]
        gaps = max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, kept = plain(turns, marks)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [marks.count(k) for k in ("blank", "duplicate", "truncated")]
        found[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return found


def conversations():
    rng = random.Random(5)
    said = ["Yes.", "No!", "Why?", "no end", "", " \n", "Yes.", "x. ", " ", "long " * 3000, None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "u2"]
    rows = [
        (conv, rng.choice([None, *range(12)]) if rng.random() < 0.2 else n, rng.choice(roles), rng.choice(said))
        for conv in [None, *range(150)]
        for n in range(rng.randint(1, 9))
    ]
    rows += [(500, n, ("user", "assistant")[n % 2], f"turn {n}.") for n in range(40)]
    rows += [(501, 2**60 + n, rng.choice(roles[:5]), f"turn {n % 7}.") for n in range(60)]
    rows += [(502, 3, "user", "same.")] * 30 + [(503, None, None, None)] * 3
    drop = next(n for n in range(1000) if zlib.crc32(f"600:{n}".encode()) % 20 == 0)
    return rows + [(600, drop, "user", "all gone.")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA)


@pytest.mark.parametrize("block", [4096, 3])
def test_audits(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", block)
    rows = conversations()
    table = frame(spark, rows)
    found = conversation_repair.audits(conversation_repair.damaged(table), table).collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in found}
    want = expected(rows)
    assert len(found) == len(got) and set(got) == set(want)
    for conv in want:
        assert got[conv] == want[conv], conv
    assert got[600] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns(spark):
    rows = conversations()
    table = frame(spark, rows)
    damaged = conversation_repair.damaged(table)
    joined = {}
    for r in sorted(conversation_repair.repaired(damaged).collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"], r["number"])):
        joined.setdefault(r["conv_id"], []).append(r)
    for conv, turns in joined.items():
        assert [r["number"] for r in turns] == list(range(len(turns)))
        assert GOAL.fullmatch("".join(r["role"][0] for r in turns)), conv
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in conversation_repair.audits(damaged).collect()}
    for conv, turns in joined.items():
        text = "\n".join(f"{r['role']}:{r['text']}" for r in turns)
        assert hashes[conv] == hashlib.sha256(text.encode()).hexdigest()


def test_least_of_all_edit_strings():
    """Every edit string is tried; those that give a legal conversation compete by cost and letters."""
    rng = random.Random(2)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice([None, None, "blank", "truncated"])) for _ in range(rng.randint(0, 4))]
        best = None
        for length in range(len(rows) + 4):
            for letters in itertools.product("DIKR", repeat=length):
                if len(letters) - letters.count("I") != len(rows):
                    continue
                state, cost, at, legal = 0, 0, 0, True
                for letter in letters:
                    if letter == "I":
                        state, cost = {0: 2, 1: 2, 2: 3, 3: 2}[state], cost + 2
                        continue
                    initial, fault = rows[at]
                    at += 1
                    if letter == "D":
                        cost += 3
                        continue
                    cost += (fault == "truncated") + 2 * (letter == "R")
                    if fault == "blank":
                        legal = False
                    if letter == "R":
                        state = {0: 2, 1: 2, 2: 3, 3: 2}[state]
                    else:
                        state = {"s0": 1, "u0": 2, "u1": 2, "u3": 2, "a2": 3}.get(f"{initial}{state}", 9)
                    if state == 9:
                        legal = False
                        break
                if legal and state in (0, 3) and (best is None or (cost, "".join(letters)) < best):
                    best = (cost, "".join(letters))
        paths = [(0, after, cost, audit) for after, cost, audit in conversation_repair.best_edits(0, rows)]
        cost, steps = conversation_repair.chained([paths] if rows else [])
        assert (cost, "".join(edits for _, edits in steps)) == best


def test_prefixes_compare_as_strings(monkeypatch):
    rng = random.Random(1)
    for base in (1_000_003, 0):  # 0: every hash is that of the last letter, so equal hashes are common
        monkeypatch.setattr("topicmill.llm.edit_prefixes._BASE", base)
        nodes = Prefixes()
        for _ in range(400):
            nodes.add(rng.randrange(len(nodes.parent)), rng.choice("DIK"))
        for _ in range(3000):
            x, y = rng.randrange(401), rng.randrange(401)
            assert nodes.less(x, y) == (nodes.text(x) < nodes.text(y))


def test_no_rows(spark):
    empty = frame(spark, [])
    assert conversation_repair.audits(conversation_repair.damaged(empty), empty).count() == 0
    assert conversation_repair.repaired(empty).count() == 0
