"""Content-defined chunks and document fingerprints, against byte-by-byte definitions."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from ledgerlake.llm import chunks
from ledgerlake.llm.common import table


def plain_ends(text):
    """The chunk ends, one byte at a time."""
    cut, start, h = [], 0, 0
    hashes = []
    for byte in text:
        h = (2 * h + int(chunks._GEAR[byte])) % 2**32
        hashes.append(h)
    while start < len(text):
        end = len(text)
        for at in range(start + 1, len(text) + 1):
            size, bits = at - start, None
            if chunks.SMALLEST <= size < chunks.USUAL:
                bits = chunks.STRICT
            elif size >= chunks.USUAL:
                bits = chunks.LOOSE
            if len(text) - start > chunks.SMALLEST and (size == chunks.LARGEST or bits and hashes[at - 1] >> (32 - bits) == 0):
                end = at
                break
        cut.append(end)
        start = end
    return cut


def plain_fingerprint(text):
    found, start = {}, 0
    for end in plain_ends(text):
        found[xxhash.xxh3_64_intdigest(text[start:end])] = end - start
        start = end
    return found


def test_ends_equal_definition(sf_dir, spark, monkeypatch):
    texts = [r.text.encode() for r in table(spark, sf_dir, "documents").orderBy("doc_id").limit(40).collect()]
    rng = random.Random(1)
    texts += [b"", b"a", b"a" * 5000, bytes(rng.randrange(256) for _ in range(20_000)), b"x" * 64, b"x" * 65]
    want = [plain_ends(t) for t in texts]
    assert [chunks.ends(np.frombuffer(t, np.uint8)) for t in texts] == want
    monkeypatch.setattr(chunks, "BLOCK", 100)
    assert [chunks.ends(np.frombuffer(t, np.uint8)) for t in texts] == want


def brute(rows):
    """rows: (doc_id, text) with distinct ids or texts, in any order."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (plain_fingerprint(t.encode()) for t in (text, edited, after))
        share = [(sum(n for k, n in a.items() if k in x) / sum(a.values())) if a else float(not x) for x in (b, c)]
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest(), chunks.written(a), chunks.written(b), *share))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [1, 7, None])
def test_documents(spark, sf_dir, buckets):
    docs = table(spark, sf_dir, "documents").filter("length(text) < 4000")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, chunks.fingerprints(docs, buckets).collect()), key=str) == want


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(3, "only one")],
        [(3, None)],
        [(1, "äöü" * 300), (1, "b" * 900), (2, ""), (None, "n" * 500), (None, None), (9, "b" * 900), (9, "b" * 900)],
    ],
)
def test_nulls_ties_and_small_tables(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, bucket int, fingerprint string")
    got = sorted(map(tuple, chunks.fingerprints(docs, 3).collect()), key=str)
    assert got == brute(rows)


def test_moved_text_keeps_its_chunks():
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(2000)).encode()
    a, b = chunks.chunk_set(text), chunks.chunk_set(b"some words put first " + text)
    assert chunks.likeness(a, b) > 0.9 and chunks.likeness(a, a) == 1.0
    assert chunks.likeness(a, chunks.chunk_set(text[::-1])) < 0.05


def test_short_documents_keep_their_likeness_to_an_edited_copy(spark):
    """An edited copy shares half of a text; short texts must show most of that half."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) < 1000 AND length(text) >= 100")
    got = [(r.n_chars, r.near_edited) for r in chunks.fingerprints(docs).collect()]
    for low, high, least in ((100, 250, 0.15), (250, 500, 0.3), (500, 1000, 0.38)):
        near = [x for n, x in got if low <= n < high]
        assert len(near) > 10 and sum(near) / len(near) >= least
        assert sum(x == 0 for x in near) <= (0.35 if high == 250 else 0.05) * len(near)
