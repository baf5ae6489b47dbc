"""Packing: every id once, as the tokenizer gives it; the curve visits neighbours."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerlake.llm import packing
from ledgerlake.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(pieces, texts, length):
    """pieces of {doc_id: text}; doc_ids are unique."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            part = np.array(ids[d][p.start : p.start + p.length], dtype="<u4")
            assert p.start == at and p.doc_tokens == len(ids[d]) and p.ids_crc32 == zlib.crc32(part.tobytes())
            at += p.length
        assert at == len(ids[d])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, ps in by_sequence.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        padded = ps[0].padded_length
        assert at == length if s < max(by_sequence) else padded in (at, length) and at <= length
        assert padded == length or padded & (padded - 1) == 0


def test_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check(packing.packed(docs, PATH).collect(), {r.doc_id: r.text for r in docs.collect()}, 2048)


def test_special_strings_spaces_and_nulls(spark):
    texts = {1: None, 2: "", 3: "a<|endoftext|>b <|startoftext|>", 4: "İ Σ́\x1cx y\x85z 's we'll", 5: "w " * 5000, 6: "one", 7: "one"}
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts.items()], "doc_id long, text string, ids string")
    check(packing.packed(docs, PATH, length=64).collect(), texts, 64)


def test_repeats_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    got = packing.packed(docs, PATH, length=4).collect()
    assert sum(p.length for p in got) == 2 + 1 + 3 + 3
    assert sorted((p.sequence_id * 4 + p.offset, p.length) for p in got)[0][0] == 0
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_curve_is_a_walk():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits, dtype=np.uint64)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = packing.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)].astype(int), axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_are_neighbours():
    rng = np.random.default_rng(0)
    table = packing.signs(1000)
    topics = [rng.integers(100 * k, 100 * k + 100, (30, 400)) for k in range(10)]
    keys = packing.hilbert(packing.cells(np.stack([packing.projection(d, table) for t in topics for d in t])), packing.BITS)
    topic = np.repeat(np.arange(10), 30)[np.argsort(keys)]
    assert (topic[1:] == topic[:-1]).mean() > 0.5  # 0.1 by chance


def test_many_words_are_learned_once(monkeypatch):
    """Words of a batch are known in the next, and words that were forgotten are learned again, with the same ids."""
    with open(PATH, encoding="utf-8") as f:
        source = f.read()
    texts = [" ".join(f"w{i}" for i in range(n, n + 1000)).encode() for n in range(0, 310_000, 1000)]
    known, learned = packing.WordIds(source), []
    learn = known.learn
    monkeypatch.setattr(known, "learn", lambda hashes, words: (learned.append(len(words)), learn(hashes, words))[1])
    first, again = known.ids_of(texts, 1), known.ids_of(texts, 1)
    assert learned == [310_000]
    monkeypatch.setattr(packing, "REMEMBERED", 10)
    some = [texts[5] + b" new", b"w1 w309999 other", b""]
    known.forget()
    known.met[:] = np.arange(len(known.met)) % 3  # two thirds are dropped
    got = known.ids_of(some, 1)
    assert len(known.hashes) < 150_000 and (np.diff(known.hashes.astype(float)) >= 0).all()
    tokenizer = Tokenizer.from_str(source)
    assert [g.tolist() for g in got] == [tokenizer.encode(t.decode(), add_special_tokens=False).ids + [1] for t in some]
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
