"""Substring deduplication against brute force, and the suffix automaton against enumeration."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import substrings
from ledgerlake.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = substrings.LAST


def brute(rows, length=13):
    """rows: (doc_id, text)."""
    split = [(LAST if d is None else d, WORD.findall(t or "")) for d, t in rows]
    owner = {}
    for d, words in split:
        for i in range(len(words) - length + 1):
            w = tuple(words[i : i + length])
            owner[w] = min(d, owner.get(w, d))
    out = []
    for (d, words), (doc_id, _) in zip(split, rows, strict=True):
        gone = {i + k for i in range(len(words) - length + 1) if owner[tuple(words[i : i + length])] < d for k in range(length)}
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(30))
def test_automaton_owners(seed):
    rng = random.Random(seed)
    length = rng.choice([1, 2, 3])
    texts = [([bytes([rng.choice(b"abc")]) for _ in range(rng.randrange(12))], rng.randrange(9)) for _ in range(6)]
    automaton = substrings.Automaton()
    for words, d in texts:
        automaton.add(words, d)
    automaton.finish()
    for words in [w for w, _ in texts] + [[bytes([rng.choice(b"abcd")]) for _ in range(12)]]:
        want = [
            min((d for t, d in texts if any(t[j : j + length] == words[i : i + length] for j in range(len(t) - length + 1))), default=LAST)
            for i in range(len(words) - length + 1)
        ]
        assert automaton.owners(words, length) == want


def test_planes():
    rng = np.random.default_rng(0)
    for top in (1, 300, 2**40, 2**63):
        values = rng.integers(0, top, 50, dtype=np.uint64)
        data = b"xy" + substrings.planes(values) + b"z"
        back, end = substrings.unplaned(data, 50, 2)
        assert (back == values).all() and data[end:] == b"z"


@pytest.mark.parametrize("common", [1000, 1])
def test_documents(spark, common):
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("doc_id % 2 = 0 or doc_id < 300")
    assert got(substrings.deduplicated(docs, common=common)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize(("length", "grain", "common"), [(13, 8, 1000), (3, 2, 2), (2, 1, 1000), (4, 4, 1)])
def test_random_documents(spark, length, grain, common):
    rng = random.Random(length)
    rows = [(rng.choice([None, *range(25)]), rng.choice([" ", "\n", " \t"]).join(rng.choices("aabc", k=rng.randrange(40)))) for _ in range(60)]
    rows += [(3, None), (4, ""), (5, "a " * 40), (5, "a " * 40), (None, "b c " * 30), (None, "b c " * 30)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, key int, route int")
    assert got(substrings.deduplicated(docs, length, grain, common)) == brute(rows, length)


def test_small_gathering_changes_nothing(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdef", k=60)).encode() for _ in range(30)]
    batch = pa.record_batch([pa.array(range(30), pa.int64()), pa.array(texts)], ["key", "text"])

    def pairs():
        made = list(substrings.gathered([batch], 5, 3))
        return len(made), {(int(a), int(k)) for anchor, key in made for a, k in zip(anchor, key, strict=True)}

    parts, want = pairs()
    monkeypatch.setattr(substrings, "GATHERED", 20)
    assert parts == 1 and pairs()[0] > 10 and pairs()[1] == want


def test_lists_are_added_up():
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, 50, 20)).astype(np.uint64) for _ in range(5)]
    anchor, count = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for x in lists:
        anchor, count = substrings.added(anchor, count, x, np.ones(len(x), np.uint64))
    assert dict(zip(anchor.tolist(), count.tolist(), strict=True)) == Counter(np.concatenate(lists).tolist())


def test_another_number_of_cores_changes_nothing(spark, tmp_path):
    """The result is planned with eight tasks and collected with two."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("doc_id < 400")
    docs.repartition(6).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    name = "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set(name, 6)
    try:
        found = substrings.deduplicated(docs)
        spark.conf.set(name, 2)
        assert got(found) == want
    finally:
        spark.conf.unset(name)


def test_empty_table(spark):
    assert got(substrings.deduplicated(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_passages_are_done_with_when_texts_move(spark):
    """The shuffles of passages and of texts do not lie on disk together: what is removed is written between."""
    line = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, line), (2, f"x {line} y")], "doc_id long, text string")
    got = substrings.deduplicated(docs)
    assert not any("llm-passages" in f or "llm-verdicts" in f for f in got.inputFiles())
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 20)]
