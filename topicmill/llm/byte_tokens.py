"""Token ids of whole texts by a byte-level tokenizer file of the ``tokenizers`` library.

The ids of such a file's entries are also their merge ranks, so ``tiktoken`` gives the
same ids from the same file several times faster. It is only asked for texts whose runs
of either kind, white space or not, are short; its work grows with the square of a run.
"""

from __future__ import annotations

import os
import re

import numpy as np

from topicmill.llm.common import worker_state

#: Texts with a longer run are encoded by the ``tokenizers`` library itself.
LONGEST_RUN = 400
_WHITE = re.compile(r"\s{%d}" % LONGEST_RUN)


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteTokenizer:
    """Encodes texts; ``pieces`` and ``sizes`` are the bytes of each id and their number.

    With ``plain`` the strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str, pattern: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        self._slow.encode_special_tokens = plain
        self._plain = plain
        special = {t.content: i for i, t in self._slow.get_added_tokens_decoder().items()}
        alphabet = byte_alphabet()
        vocabulary = self._slow.get_vocab()
        self.pieces = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.pieces[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        ranks = {self.pieces[i]: i for token, i in vocabulary.items() if token not in special}
        self._fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text as little-endian 32-bit numbers; a null text has none."""
        if not text:
            ids = []
        elif max(map(len, text.split()), default=0) > LONGEST_RUN or _WHITE.search(text):
            ids = self._slow.encode(text, add_special_tokens=False).ids
        elif self._plain:
            ids = self._fast.encode_ordinary(text)
        else:
            ids = self._fast.encode(text, allowed_special="all")
        return np.asarray(ids, "<u4")


def byte_tokenizer(path: str, pattern: str, plain: bool = False) -> ByteTokenizer:
    """This worker's tokenizer for a file."""
    return worker_state(("byte tokenizer", path, pattern, plain), lambda: ByteTokenizer(path, pattern, plain))
