"""Personal data: patterns against their definition, belief propagation against enumeration, what the field adds."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from ledgerlake.llm import pii
from ledgerlake.llm.common import table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_patterns_on_random_texts():
    rng = random.Random(11)
    parts = ["a", "b.", "@", "@x.y", ".", "-", " ", "1", "25", "256", "4", "1.2.3.4", "+", "+1 ", "(2)", "555-", "4111111111111111", "é", "٣", "\n", "_", "%", "0000"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(16)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_patterns_on_documents(spark, sf_dir):
    for r in table(spark, sf_dir, "documents").collect():
        assert pii.base_spans(r.text) == plain_spans(r.text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1.1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 200_000):
        pii.base_spans(text)
        pii.nodes([text])


def test_messages_give_exact_marginals_on_a_tree():
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), rng.random((2, pii.LABELS)))
    n = 4
    found = pii.Nodes([[i, i + 7] for i in range(n)], [(0, i, i + 1) for i in range(n)], [0] * n, [(0, 1)], [(1, 2)], [(1, 3)])
    want = np.zeros((n, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=n):
        score = sum(field.unary[f, y[i]] for i in range(n) for f in found.features[i]) + field.chain[y[0], y[1]]
        score += field.skip[0, y[1]] * (y[1] == y[2]) + field.skip[1, y[1]] * (y[1] == y[3])
        for i in range(n):
            want[i, y[i]] += np.exp(score)
    assert np.allclose(pii.marginals(field, found), want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_skip_edges_carry_a_label_across_the_document():
    field = pii.Field(np.zeros((pii.FEATURES, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), np.full((2, pii.LABELS), 3.0))
    text = "sure 77x5 " + "word " * 500 + "77x5 again"
    found = pii.nodes([text])
    alone = pii.marginals(field, found)[1]
    field.unary[found.features[0][-2]] = [0, 0, 0, 6, 0]  # only the first place says what it is
    linked = pii.marginals(field, found)[1]
    assert np.allclose(alone, 0.2) and linked[3] > 0.8


@pytest.fixture(scope="module")
def field(spark):
    return pii.fitted(table(spark, "/root/testdata/sf0.1", "documents"))


def test_field_adds_what_resembles_and_leaves_the_rest(field):
    bad = "4111 1111 1111 1112"
    texts = ["it was 1232810148878565 there", "see 999.1.2.3 ok", "version 3. and CC BY-NC 4.0. of 2024", "plain words", "in 12 or 100 days", bad]
    added = [[s for s in every if s not in base] for base, every in pii.spans_of(field, texts)]
    assert added == [[("card", 7, 23)], [("ip", 4, 13)], [], [], [], []]


def test_field_on_held_out_documents(spark, field):
    """Words of base spans, hidden from the decision, are told apart by the field alone."""
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").collect()]
    found = pii.nodes(texts)
    y, p = np.array(found.labels), pii.marginals(field, found)
    known = y >= 0
    assert (p[known].argmax(axis=1) == y[known]).mean() > 0.97
    assert (p[y == 0][:, 1:].max(axis=1) < pii.LEAST).mean() > 0.99


def test_rows(spark, sf_dir, field):
    docs = table(spark, sf_dir, "documents")
    got = {r.doc_id: r for r in pii.personal_data(docs, field).collect()}
    for r in docs.collect():
        base, g = plain_spans(r.text), got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(s[0] == k for s in base) for k in PATTERNS]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(g.spans.split(",") if g.spans else [])


def test_nulls_repeats_empty_and_redaction(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "mail é a@b.cd, a@b.cd", None), (2, "+1 (243) 555-5526", "y"), (2, "+1 (243) 555-5526", "y")]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), r[2]) for r in rows], "doc_id long, text string, spans string, n_chars int, source string")
    got = sorted(map(tuple, pii.personal_data(docs).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    mails, phone = "email:7:13,email:15:21", "phone:0:17"
    assert got == sorted(
        [(1, 0, 0, 0, 0, empty, "")] * 2
        + [(None, 2, 0, 0, 0, hashlib.sha256(mails.encode()).hexdigest(), mails)]
        + [(2, 0, 0, 0, 1, hashlib.sha256(phone.encode()).hexdigest(), phone)] * 2,
        key=str,
    )
    clean = pii.redacted(docs)
    assert clean.schema == docs.schema
    assert sorted(((r.text, r.n_chars) for r in clean.collect()), key=str) == sorted(
        [(None, None), ("", 0), ("mail é [EMAIL], [EMAIL]", 23), ("[PHONE]", 7), ("[PHONE]", 7)], key=str
    )
    assert pii.personal_data(docs.limit(0)).collect() == [] and pii.redacted(docs.limit(0)).collect() == []
    assert pii.masked("abcdef", [("email", 0, 3), ("ip", 2, 4)]) == "[EMAIL]ef"


def told_once(occurrences, at):
    """Probabilities of the places of a number of which only one place says what it is."""
    field = pii.Field(np.zeros((pii.FEATURES, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), np.full((2, pii.LABELS), 3.0))
    found = pii.nodes([" ".join(f"w{'x' * (i % 7)} 77x5" if i != at else "sure! 77x5" for i in range(occurrences)).replace("w", "word ")])
    field.unary[pii.hashed("before a!")] = [0, 0, 0, 6, 0]
    return pii.marginals(field, found)


@pytest.mark.parametrize("at", [0, 25])
def test_evidence_reaches_all_of_fifty_occurrences(at):
    p = told_once(50, at)
    assert len(p) == 50 and p[:, 3].min() > 0.8
    others = np.delete(p[:, 3], at)
    assert others.max() - others.min() < 0.01


def test_two_nodes_at_a_hub_are_tied_as_by_an_edge():
    rng = np.random.default_rng(3)
    field = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), rng.random((2, pii.LABELS)) * 3)
    edge = pii.Nodes([[1], [2]], [(0, 0, 1), (0, 2, 3)], [0, 0], [], [(0, 1)], [])
    hub = pii.Nodes([[1], [2]], [(0, 0, 1), (0, 2, 3)], [0, 0], [], [], [], [(0, 0), (1, 0)], [], [0])
    assert np.allclose(pii.marginals(field, edge), pii.marginals(field, hub), atol=1e-3)


def test_a_document_does_not_depend_on_its_batch(field):
    texts = ["see 999.1.2.3 or 999.1.2.3, 999.1.2.3 and 1.2.3.4", "no 17 of 17 and 17 by 12", "it was 1232810148878565 there, 4111111111111111 1232810148878565"]
    together = pii.marginals(field, pii.nodes(texts))
    assert np.array_equal(together, np.concatenate([pii.marginals(field, pii.nodes([t])) for t in texts]))


def test_messages_of_a_wild_field_come_to_rest():
    rng = np.random.default_rng(0)
    text = " ".join(rng.choice(["1", "2 x", "33", "a4", "5b", "6@"], 300))
    for _ in range(4):
        field = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)) * 3, rng.normal(size=(pii.LABELS, pii.LABELS)) * 4, rng.random((2, pii.LABELS)) * 8)
        assert np.allclose(pii.marginals(field, pii.nodes([text])).sum(axis=1), 1)
