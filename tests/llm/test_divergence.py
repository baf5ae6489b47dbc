"""The divergence audit against a plain count, and the tree's corrections against sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import divergence
from ledgerlake.llm.common import table

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain_audit(rows, least=10, top=10):
    """rows: (text, lang, source)."""
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(SMALL))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        v = len(kept)

        def shares(count, kept=kept, v=v):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * v) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        of = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(f(of[s][t], of[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(of[s][t], q[t])) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, x, r) for r, (i, x) in enumerate(found, 1) if part == "pair" or r <= top}
    return out


def audited(spark, rows, **options):
    docs = spark.createDataFrame([(t, lang, s, 1, "x") for t, lang, s in rows], "text string, lang string, source string, n int, term string")
    return {tuple(r) for r in divergence.audited(docs, **options).collect()}


def test_equals_plain_count(spark):
    rng = random.Random(3)
    words = ["a", "Ä", "ä", "Über", "naïve", "x-y", "don't", "日本", "b2c", "zz"] + [f"{c}{d}" for c in "abcdefg" for d in "hijk"]
    rows = []
    for _ in range(400):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", None, "S1", "ß"])
        rows.append((rng.choice([" ", "\n", "_", "1"]).join(rng.choices(words, k=rng.randrange(30))), lang, source))
    rows += rows[:50] + [(None, "en", "s1"), ("", "en", "empty"), ("only here", "xx", "alone"), ("only here", "xx", "other"), (None, None, None)]
    for least, top in ((10, 10), (1, 3), (10**6, 10)):
        assert audited(spark, rows, least=least, top=top) == plain_audit(rows, least, top)


def test_ties_rank_by_item(spark):
    rows = [("b a C é z", "en", s) for s in ("two", "one")] + [("other words", "en", "three")]
    assert audited(spark, rows, least=1) == plain_audit(rows, 1)


def test_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert {tuple(r) for r in divergence.audited(docs).collect()} == plain_audit(rows)


def test_empty_table(spark):
    assert audited(spark, []) == set()


def test_long_text_and_many_terms(spark, monkeypatch):
    """A text of several stretches, and counts that are sent in several parts, change nothing."""
    long = " ".join(f"W{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é" for i in range(400_000))
    rows = [(long, "en", "s"), ("waaé wbaé", "en", "t")]
    assert audited(spark, rows, least=1) == plain_audit(rows, 1)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = sorted(map(tuple, divergence.term_counts(docs).collect()), key=str)
    monkeypatch.setattr(divergence, "GATHERED", 5)
    assert sorted(map(tuple, divergence.term_counts(docs).collect()), key=str) == want


def test_counts_beyond_long_products(spark):
    """Shares of counts whose product with the scale passes 63 bits are exact."""
    df = spark.createDataFrame([(9 * 10**15, 10**16, 7)], "n long, total long, v long")
    assert df.select(divergence.share("n", "total")).first()[0] == 1 + 10**9 * (9 * 10**15 + 2) // (10**16 + 14)


@pytest.mark.parametrize("cells", [1 << 21, 12])
def test_tree_corrections(monkeypatch, cells):
    """Shared paths with multiplicities, in blocks of any size, against a sum over rows."""
    import pyarrow as pa

    monkeypatch.setattr(divergence, "CELLS", cells)
    rng = random.Random(5)
    p0 = [rng.randrange(1, 50) for _ in range(6)]
    rows = Counter()
    for _ in range(500):
        chosen = sorted(rng.sample(range(6), rng.randrange(1, 6)))
        rows[rng.choice("xy"), tuple((s, p0[s] + rng.randrange(1, 4) * 1000, p0[s]) for s in chosen)] += rng.randrange(1, 5)
    want = Counter()
    f = divergence.gaps
    for (lang, items), m in rows.items():
        for i, (a, x, xa) in enumerate(items):
            for b, y, yb in items[i + 1 :]:
                want[lang, a, b] += m * (f(x, y) - f(x, yb) - f(xa, y) + f(xa, yb))
    ordered = sorted(rows)
    item = pa.list_(pa.struct([("place", pa.int64()), ("p", pa.int64()), ("p0", pa.int64())]))
    named = [[dict(zip(("place", "p", "p0"), i, strict=True)) for i in items] for _, items in ordered]
    batch = pa.record_batch([pa.array([lang for lang, _ in ordered]), pa.array(named, item), pa.array([rows[r] for r in ordered], pa.int64())], ["lang", "items", "m"])
    got = Counter()
    for lang, *block in divergence.blocks([batch]):
        for a, b, value in zip(*divergence.corrections(*block), strict=True):
            got[lang, int(a), int(b)] += int(value)
    assert got == want


def test_equal_rows_are_inserted_once(spark):
    """Terms with the same counts in the same sources make one row of the tree, with a multiplicity."""
    rows = [(t, 1, 5, 2, "en") for t in "abc"] + [(t, 2, 7, 3, "en") for t in "abc"] + [("d", 1, 6, 2, "en"), ("d", 2, 7, 3, "en")]
    terms = spark.createDataFrame(rows, "term string, place long, p long, p0 long, lang string")
    got = {(r.a, r.b): r.value for r in divergence.both_terms(terms, 1).groupBy("a", "b").agg(F.sum("value").alias("value")).collect()}
    p, q = np.array([5, 5, 5, 6]), 7
    f = divergence.gaps
    assert got == {(1, 2): int((f(p, q) - f(p, 3) - f(2, q) + f(2, 3)).sum())}
