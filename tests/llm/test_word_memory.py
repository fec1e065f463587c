"""What the word-wise tokenizer remembers."""

import public_tokenizers
from topicmill.llm import catalog, word_tokens


def test_frequent_words_outlast_a_full_memory(monkeypatch):
    tokenizer = word_tokens.WordTokenizer(public_tokenizers.path(catalog.WORD_FILE))
    whole = tokenizer._whole
    monkeypatch.setattr(word_tokens, "REMEMBERED", 20)
    cut, find = [], word_tokens.RUNS.findall

    class Runs:
        @staticmethod
        def findall(word):
            cut.append(word)
            return find(word)

    monkeypatch.setattr(word_tokens, "RUNS", Runs)
    for n in range(30):
        texts = [f"often, Often new{n}x other{n}; Word Ⱥb{n} " + "l" * 150, "école x²" if n % 3 else "a ’b"]
        assert tokenizer.encode_all(texts) == whole(texts)
    assert cut.count("often,") == 1
