"""Token counts against the library of the vocabulary."""

import random

import public_tokenizers
import pytest
import sentencepiece

from ledgerlake.llm import tokens
from ledgerlake.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = [" ", "  ", "\n", "▁", "a", "the", "é", "世", "́", "😀", "\t", "\r", "\x00", "<s>", "</s>", "<0x0A>", "▁" * 17, ".", "Z", "1", " " * 40, " ", "﻿", "ing"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, "rb") as f:
        return tokens.PieceCounter(f.read())


def test_random_texts(library, counter):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(5000)]
    assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_long_texts(library, counter):
    for text in ("ab" * 100_000, " " * 50_000, "word " * 100_000, "世" * 30_000):
        assert counter.count(text) == len(library.encode(text))


def test_memory_changes_nothing(counter, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    fresh = tokens.PieceCounter(open(PATH, "rb").read())
    text = "one two three one two three four one"
    assert fresh.count(text) == counter.count(text)


def test_documents(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    want = {(r.doc_id, len(r.text.encode()), len(library.encode(r.text)), len(library.encode(r.text)) > 4096) for r in docs.collect()}
    assert set(map(tuple, tokens.token_counts(docs, PATH).collect())) == want


def test_nulls_repeats_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a b", None), (2, "a b", 1), (2, "a b", 1)], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, tokens.token_counts(docs, PATH, limit=1).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (None, 3, 2, True), (2, 3, 2, True), (2, 3, 2, True)], key=str)
    assert tokens.token_counts(docs.limit(0), PATH).collect() == []
