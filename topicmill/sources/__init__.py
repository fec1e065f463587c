"""Readers: document tables, text corpora, word lists and saved stages."""
