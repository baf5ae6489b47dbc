"""Circulant MinHash: the permutations, and components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from ledgerlake.llm import minhash
from ledgerlake.llm.common import staged, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, n=2):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def plain_roots(sets, similarity=80, may=lambda a, b: True):
    """The first position of each set's component; empty sets link with nothing."""
    root = list(range(len(sets)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= similarity * (len(a) + len(sets[j]) - common) and may(i, j):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(sets))]


def plain_rows(docs):
    """docs: (doc_id, text); (doc_id, n_shingles, component_id, kept) of each row."""
    sets = [plain_set(t) for _, t in docs]
    roots = plain_roots(sets)
    least = {}
    for (d, _), r in zip(docs, roots, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    out = []
    for (d, _), s, r in zip(docs, sets, roots, strict=True):
        component = least.get(r) if s else d
        out.append((d, len(s), component, component is None if d is None else d == component))
    return sorted(out, key=str)


def got(spark, docs, **options):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, label string, node int")
    return sorted(map(tuple, minhash.near_duplicates(df, **options).collect()), key=str)


@pytest.mark.parametrize("text", ["", " \t", "One", "one One", "a b a b a", "À É\x0bü x\x0cY", "w " * 70_001, "x" * 3_000_000 + " y"])
def test_shingles(text):
    assert len(minhash.shingles(text.encode())) == len(plain_set(text))


def test_permutations_can_be_undone():
    x = np.random.default_rng(1).integers(0, 2**32, 100_000, dtype=np.uint32)
    y = minhash.permuted(x.copy(), 0x7FEB352D, 0x846CA68B)
    for s, f in ((16, None), (15, 0x846CA68B), (16, 0x7FEB352D)):
        if f:
            y *= np.uint32(pow(f, -1, 2**32))
        whole = y.copy()
        for _ in range(3):
            whole = y ^ (whole >> np.uint32(s))
        y = whole
    assert (x == y).all()


@pytest.mark.parametrize("at_once", [256, 7])
def test_coordinates_estimate_similarity(monkeypatch, at_once):
    """Coordinates shift one permutation, and agree as often as the sets are alike."""
    monkeypatch.setattr(minhash, "AT_ONCE", at_once)
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**64, 1200, dtype=np.uint64)
    a, b = h[:1000], h[200:]
    one, other = minhash.signature(a, 2000), minhash.signature(b, 2000)
    assert abs((one == other).mean() - 800 / 1200) < 0.05
    scattered = minhash.permuted((a >> np.uint64(32)).astype(np.uint32), 0x21F0AAAD, 0xD35A2D97)
    assert one[17] == minhash.permuted(scattered - np.uint32(17), 0x7FEB352D, 0x846CA68B).min()


def test_components_on_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    want = plain_rows([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str) == want
    assert sum(not r[3] for r in want) > 5


def family(rng, words, edits):
    """A text, and copies in which some words are replaced."""
    base = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
    yield " ".join(base)
    for _ in range(edits):
        copy = list(base)
        for _ in range(rng.randrange(1, max(2, len(base) // 12))):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        yield " ".join(copy)


def test_families_near_the_threshold(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    docs = [t for _ in range(8) for t in family(rng, words, 25)]
    rng.shuffle(docs)
    docs = [(100 + 3 * i, t) for i, t in enumerate(docs)]
    assert got(spark, docs) == plain_rows(docs)


@pytest.mark.parametrize("tile", [1024, 16])
def test_every_pair_of_a_bucket_is_compared_or_in_one_component(spark, monkeypatch, tile):
    """Buckets of one coordinate hold nearly everything, and few pairs link: pairs of tiles must find them."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(12)
    docs = []
    for i in range(150):
        common = [f"c{j}" for j in range(40)]
        docs.append((i, " ".join(common + [f"u{rng.randrange(30)}x{j}" for j in range(rng.randrange(8, 16))])))
    docs += [(900 + i, docs[140 - 7 * i][1] + " tail") for i in range(9)]
    want = plain_rows(docs)
    assert sum(not r[3] for r in want) >= 9
    assert got(spark, docs, bands=60, rows=1) == want


def test_tiles_hold_every_pair_of_two_components_once(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    rows = [(1, n, 10, 0, 10, 0 if n < 30 else n) for n in range(60)] + [(2, n, 10, 0, 10, 0) for n in range(9)] + [(3, n, 10, 5, 10, n) for n in (5, 6)]
    members = spark.createDataFrame(rows, "bucket long, node long, size long, lead long, lead_size long, label long")
    units = {}
    for r in minhash.tiled(members).collect():
        units.setdefault((r.bucket, r.left, r.right), []).append((r.node, r.own, r.label))
    assert all(len(u) < 60 for u in units.values()) and len(units) > 10
    met = []
    for (bucket, left, right), unit in units.items():
        met += [(bucket, *sorted((a[0], b[0]))) for i, a in enumerate(unit) for b in unit[:i] if a[2] != b[2] and (left == right or a[1] != b[1])]
    want = {(1, a, b) for a in range(60) for b in range(max(30, a + 1), 60)} | {(3, 5, 6)}
    assert len(met) == len(want) and set(met) == want


def test_signatures_rule_out_no_link():
    """At the threshold the share of equal coordinates stays above the limit; far below it does not reach it."""
    rng = np.random.default_rng(8)
    limit = 0.8 + 0.2 / 256 - minhash.SURE * np.sqrt(0.16 / minhash.LONG)
    for shared, extra, linked in ((80, 10, True), (800, 100, True), (8, 1, True), (400, 200, False)):
        shares = []
        for _ in range(60):
            h = rng.integers(0, 2**64, shared + 2 * extra, dtype=np.uint64)
            one, other = (minhash.signature(x, minhash.LONG).astype(np.uint8) for x in (h[: shared + extra], np.concatenate((h[:shared], h[shared + extra :]))))
            shares.append((one == other).mean())
        assert min(shares) > limit if linked else max(shares) < limit


def test_exact_threshold_and_small_sets(spark):
    docs = [(1, "a b c d e f"), (2, "a b c d e"), (3, "a b"), (4, "b a"), (5, "A  b"), (6, "solo"), (7, "SOLO\n"), (8, "solo solo"), (9, "a b c d")]
    rows = plain_rows(docs)  # 4 of 5 shingles is a link, 3 of 4 is none
    assert (2, 4, 1, False) in rows and (9, 3, 9, True) in rows
    assert got(spark, docs) == rows


def test_nulls_repeated_rows_and_other_columns(spark):
    docs = [(5, "a b c d"), (5, "a b c d"), (2, "A b c d"), (None, "a b c d"), (7, None), (9, ""), (None, "z"), (None, "z"), (None, None), (5, "q r s"), (1, "q r s"), (1, " ")]
    assert got(spark, docs) == plain_rows(docs)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_a_large_group_needs_few_comparisons(spark):
    """One group of near copies: far fewer pairs are compared than it has."""
    rng = random.Random(13)
    base = [f"b{i}" for i in range(200)]
    docs = [(i, " ".join([*base[:k], f"n{i}", *base[k:]])) for i, k in enumerate(rng.choices(range(200), k=400))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = got(spark, docs)
    assert {r[2] for r in rows} == {0}
    signed = staged(minhash.signed(df, 2, 40, 5), "test-signed")
    sets = signed.select("doc_id", "buckets", signed.doc_id.alias("node"), signed.n_shingles.alias("size"))
    pairs = minhash.led(minhash.members_of(sets), 80).count()
    assert 399 <= pairs < 400 * 40


def test_a_large_group_is_verified_by_few_pairs(spark, monkeypatch):
    """Near copies of one text, and of another near the threshold to it: pairs on full sets grow with the rows, not with their square."""
    rng = random.Random(14)
    base = [f"b{i}" for i in range(100)]
    far = [*base[:60], *(f"f{i}" for i in range(5)), *base[66:]]
    docs = [(i, " ".join([*half[:k], f"n{i}", *half[k:]])) for i, k in enumerate(rng.choices(range(90), k=300)) for half in ((base, far)[i % 2],)]
    seen, linked = [], minhash.linked

    def counted(pairs, sets, similarity):
        pairs = staged(pairs, "test-pairs")
        seen.append(pairs.count())
        return linked(pairs, sets, similarity)

    monkeypatch.setattr(minhash, "linked", counted)
    assert got(spark, docs) == plain_rows(docs)
    assert sum(seen) < 2 * len(docs)


def test_one_pair_for_two_components(spark):
    """The likeliest pair of two components, whichever way round; the pairs of components that roots join fall away."""
    rows = [(1, 5, 10, 20, 7), (2, 6, 10, 20, 9), (3, 7, 20, 10, 8), (1, 8, 10, 30, 1)]
    pairs = spark.createDataFrame(rows, "a long, b long, label_a long, label_b long, equal long")
    assert sorted(map(tuple, minhash.likeliest(pairs).collect())) == [(1, 8, 10, 30), (2, 6, 10, 20)]
    roots = spark.createDataFrame([(20, 10)], "node long, root long")
    assert [tuple(r) for r in minhash.still_apart(pairs, roots).collect()] == [(10, 30)]


@pytest.mark.parametrize("tile", [1024, 16])
def test_candidates_below_the_threshold_make_few_rows(spark, monkeypatch, tile):
    """All texts are candidates of each other and few are linked: tasks return no more rows than they are given."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(15)
    docs = []
    for i in range(60):
        text = [f"b{j}" for j in range(800)]
        for j in rng.sample(range(800), 27):
            text[j] = f"n{i}x{j}"
        docs.append((i, " ".join(text)))
    docs += [(900 + i, docs[50 - 9 * i][1] + " tail") for i in range(5)]
    seen, alike = [], minhash.alike

    def counted(units, *rest):
        pairs = staged(alike(units, *rest), "test-alike")
        seen.append((pairs.count(), units.count()))
        return pairs

    monkeypatch.setattr(minhash, "alike", counted)
    want = plain_rows(docs)
    assert len({r[2] for r in want}) > 50
    assert got(spark, docs, bands=4, rows=1) == want
    assert seen and all(0 <= n < given for n, given in seen)


def test_pairs_of_a_unit_are_confirmed_until_together(spark):
    """On full sets links alone are returned, one where two already put three labels together."""
    sets = [np.arange(100), np.arange(5, 100), np.arange(8, 100), np.arange(24, 100)]
    signatures = [minhash.signature(s.astype(np.uint64) << np.uint64(32), minhash.LONG).astype(np.uint8).tobytes() for s in sets]
    known = spark.createDataFrame([(n, bytearray(signatures[0]), [7], s.tolist()) for n, s in enumerate(sets)], "node long, signature binary, buckets array<long>, shingles array<long>")
    units = spark.createDataFrame([(7, 0, 0, 0, n, 10 + n, len(s)) for n, s in enumerate(sets)], "bucket long, left int, right int, own int, node long, label long, size long")
    rows = [tuple(r)[:-1] for r in minhash.alike(units, known, 80, 1).collect()]
    assert rows == [(7, 0, 0, 0, 1, 10, 11), (7, 0, 0, 0, 2, 10, 12), (7, 0, 0, 1, 3, 11, 13)]  # 76 of 95 is a link, 76 of 100 is none
    by_signatures = minhash.alike(units, known.drop("shingles"), 80, 1).collect()
    assert [(r.a, r.b) for r in by_signatures] == [(0, 1), (0, 2), (1, 3)]  # by size, 0 and 3 are no candidates
