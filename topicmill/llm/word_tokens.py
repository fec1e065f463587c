"""Token ids of whole texts by a word-wise tokenizer file of the ``tokenizers`` library.

The file's rules never join text across a space or a line feed, so the ids of a
text are the ids of its chunks between those two characters, put together. A text
of plain Latin letters, digits and signs falls apart into runs of letters and runs
of other characters instead, inside its words between white space. Each worker encodes
a chunk, run or word once and remembers it; texts that the rules might treat otherwise
stay with the chunks.
"""

from __future__ import annotations

import os
import re
from itertools import chain, filterfalse

import numpy as np

from topicmill.llm.common import worker_state

#: Chunks and runs, and words, that a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 500_000
#: Longer chunks are encoded each time, not remembered.
LONGEST = 100
#: Letters whose lower case and normal form need no neighbours, digits and signs, but no apostrophe,
#: no superscript or fraction and no "<" (special tokens begin with it).
PLAIN = re.compile("[\t\n \x21-\x26\x28-\x3b\x3d-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ňŊ-ɏ]*")
RUNS = re.compile(r"[^\W\d_]+|(?:[^\w\s]|[\d_])+")
#: Words that are encoded as one text.
WORDS_AT_ONCE = 200


class WordTokenizer:
    """Encodes texts to little-endian 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(1 + max(vocabulary.values()), bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[str, bytes] = {"": b""}
        # words since the last full half, and of the half before: frequent ones move on
        self._words: dict[str, bytes] = {}
        self._earlier: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    def _learn(self, new: set[str]) -> None:
        words = list(filter(str.isalpha, new))
        if not PLAIN.fullmatch(" ".join(words)):
            words = list(filter(PLAIN.fullmatch, words))
        others = list(new.difference(words))
        self._known.update(zip(others, self._whole(others)))
        for start in range(0, len(words), WORDS_AT_ONCE):
            part = words[start : start + WORDS_AT_ONCE]
            encoded = self._tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.asarray(encoded[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not end each word with an end-of-word token")
            joined = ids.tobytes()
            self._known.update(zip(part, [joined[i:j] for i, j in zip([0, *ends], ends)]))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; a null text has none."""
        plain, others = [], []
        found: list[bytes] = [b""] * len(texts)
        new_words: set[str] = set()
        for n, text in enumerate(texts):
            if text and PLAIN.fullmatch(text):
                words = text.split()
                plain.append((n, words))
                new_words.update(filterfalse(self._words.__contains__, words))
            elif text:
                others.append((n, text.replace("\n", " ").split(" ")))
        if new_words or others:
            self._encode_new(new_words, plain, others, found)
        else:
            self._put(self._words, plain, found)
        return found

    @staticmethod
    def _put(known: dict[str, bytes], texts: list[tuple], found: list[bytes]) -> None:
        for n, parts in texts:
            found[n] = b"".join(map(known.__getitem__, parts))

    def _encode_new(self, new_words: set[str], plain: list[tuple], others: list[tuple], found: list[bytes]) -> None:
        """Fills in the ids of plain texts, by words, some of them new, and of others, by chunks."""
        if len(self._words) + len(new_words) > REMEMBERED // 2:
            self._earlier, self._words = self._words, {}
            new_words = set().union(*[part for _, part in plain])
        again = list(filter(self._earlier.__contains__, new_words))
        self._words.update(zip(again, map(self._earlier.__getitem__, again)))
        new_words = new_words.difference(again)
        runs = dict(zip(new_words, map(RUNS.findall, map(str.lower, new_words))))
        parts = set(chain.from_iterable(runs.values())).union(*[part for _, part in others])
        new = parts.difference(self._known)
        long = [c for c in new if len(c) > LONGEST]
        if len(self._known) + len(new) > REMEMBERED:
            self._known, new = {"": b""}, parts
        self._learn(new.difference(long))
        self._known.update(zip(long, self._whole(long)))
        known = self._known.__getitem__
        self._words.update((w, known(part[0]) if len(part) == 1 else b"".join(map(known, part))) for w, part in runs.items())
        self._put(self._words, plain, found)
        self._put(self._known, others, found)
        for part in long:
            del self._known[part]
        for part in [w for w in new_words if len(w) > LONGEST]:
            del self._words[part]


def word_tokenizer(path: str) -> WordTokenizer:
    """This worker's tokenizer for a file."""
    return worker_state(("word tokenizer", path), lambda: WordTokenizer(path))


def texts_of(column) -> list[str | None]:
    """A pandas column of texts with ``None`` for nulls."""
    return [text if isinstance(text, str) else None for text in column]
