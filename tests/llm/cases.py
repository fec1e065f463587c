"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random

import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, id string, spans string, toxicity_score string"


def sentence(rng, words):
    return " ".join(rng.choice(words) for _ in range(rng.randint(60, 120)))


def rows():
    """(doc_id, text): copies, near copies, shared passages, an overlap in one text, odd characters."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    passage = sentence(rng, words)
    found = [(i, sentence(rng, words)) for i in range(20)]
    found += [(100 + i, found[3][1]) for i in range(4)]
    found += [(200 + i, f"{sentence(rng, words)} {passage}\n{sentence(rng, words)}") for i in range(4)]
    found += [(300, "ab " * 200), (301, "x" * 700), (302, None), (303, ""), (304, " \n\t "), (305, "one word's")]
    found += [(None, sentence(rng, words)), (None, passage), (306, found[5][1] + " tail"), (307, "Ωmega ı ſ 日本 😀 12½ <|endoftext|>")]
    found += [(308, " ".join(rng.choice(words) for _ in range(20_000)))]
    return found + [found[7], found[7]]  # repeated rows


def documents(spark, some=None):
    full = [(i, t, "en", "s", None if t is None else len(t), "k", "x", "y", "z") for i, t in (rows() if some is None else some)]
    return spark.createDataFrame(full, SCHEMA)


def vectors(spark, some=None):
    """Integers in double components, so ties are many; bad vectors; a clashing column."""
    rng = np.random.default_rng(3)
    good = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(400)]
    good += [(400 + i, good[20][1]) for i in range(30)]
    bad = [(1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 6), (1060, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    short = [(2000, [1.0, 0.5]), (2020, [0.0] * 6), (2040, [])]
    found = good + bad + short if some is None else some
    return spark.createDataFrame([(i, v, 1, "c") for i, v in found], "vec_id long, embedding array<double>, cell int, v string")


def whole(found):
    """The vectors that take part, filled with zeros."""
    kept = []
    for i, v in found:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, np.array(list(v) + [0.0] * (6 - len(v)))))
    return kept
