"""Soft-membership mixing: held-out accuracy, and rates against a plain solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import mixing
from ledgerlake.llm.common import table

DOMAINS = ["good", "poor", "toxic"]


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, "/root/testdata/sf0.1", "documents"), mixing.domains_of(table(spark, "/root/testdata/sf0.1", "labels"))


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = mixing.classifier(docs, labels.filter("doc_id % 2 = 0"), DOMAINS)
    p = mixing.posteriors(docs, model, DOMAINS).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    best = F.get(F.array(*map(F.lit, DOMAINS)), F.expr("int(array_position(p, array_max(p))) - 1"))
    right = p.groupBy("domain").agg(F.avg((best == F.col("domain")).cast("double")).alias("right"), F.count("*").alias("n")).collect()
    assert sum(r.right * r.n for r in right) / sum(r.n for r in right) > 0.93
    assert {r.domain: r.right > 0.75 for r in right} == dict.fromkeys(DOMAINS, True)


def test_words_and_hashes_agree():
    import re

    rng = np.random.default_rng(1)
    parts = ["The", "é", "&&&", " ", "\n", ".", "x1", "ÀB", "\x0b", "!!", "'", "世"]
    for _ in range(500):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        want = re.findall(r"[a-z0-9\x80-\U0010ffff]+|[^a-z0-9\x80-\U0010ffff\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        assert mixing.words(text.encode()) == set(want)
        assert mixing.hashes(text.encode()).tolist() == [int(mixing.hashes(w.encode())[0]) for w in want]


def plain_rates(p, tokens, target, pull, most):
    """Many plain projected gradient steps."""
    whole, rate = tokens.sum(), np.ones(len(p))
    weigh = np.linalg.inv((p.T * tokens) @ p / whole + pull * np.eye(p.shape[1]))
    for _ in range(20_000):
        errors = weigh @ ((rate * tokens) @ p - target) / whole
        rate = np.clip(rate - (p @ errors + pull * (rate - 1)) / (1 + pull), 0, most)
    return rate


@pytest.mark.parametrize(("share", "most"), [([0.7, 0.2, 0.1], 4.0), ([0.1, 0.0, 0.9], 1.5), ([0.5, 0.5, 0.0], 100.0)])
def test_rates_solve_the_least_squares(spark, share, most):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.1], 150)
    tokens = rng.integers(0, 2000, 150)
    rows = [(i, i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p, strict=True))]
    scores = spark.createDataFrame(rows, "doc_id long, row long, tokens long, p array<float>")
    whole = float(tokens.sum())
    target = np.array(share) * whole
    steps = mixing.fitted_steps(scores, target, whole, 0.01, most)
    got = {r.row: r.rate for r in mixing.rated(scores, DOMAINS, steps, 0.01, most).collect()}
    want = plain_rates(p, tokens, target, 0.01, most)
    mine = np.array([got[i] for i in range(150)])
    weigh = np.linalg.inv((p.T * tokens) @ p / whole + 0.01 * np.eye(3))
    errors = [((r * tokens) @ p - target) / whole for r in (mine, want)]
    loss = [e @ weigh @ e + 0.01 * (tokens * (r - 1) ** 2).sum() / whole for e, r in zip(errors, (mine, want), strict=True)]
    assert len(steps) < 60
    assert mine.min() >= 0 and mine.max() <= most
    assert loss[0] <= loss[1] + 1e-4


def test_mix_of_documents(tables):
    docs, labels = tables
    got = mixing.mixed(docs, labels, {"good": 0.9, "poor": 0.1, "toxic": 0.0}).collect()
    assert len(got) == docs.count()
    whole = sum(r.tokens for r in got)
    for domain, share in (("good", 0.9), ("poor", 0.1), ("toxic", 0.0)):
        for times in ("rate", "copies"):
            assert sum(r[times] * r.tokens * r[f"p_{domain}"] for r in got) / whole == pytest.approx(share, abs=0.03)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in got)


def test_drawn_rows(tables):
    docs, labels = tables
    docs = docs.filter("doc_id < 600")
    mix = mixing.drawn(docs, labels, {"good": 1.0, "poor": 0.0, "toxic": 0.0})
    assert mix.schema == docs.schema
    copies = {r.doc_id: r.copies for r in mixing.mixed(docs, labels, {"good": 1.0, "poor": 0.0, "toxic": 0.0}).collect()}
    drawn = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert drawn == {d: c for d, c in copies.items() if c}


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(i, "fine good words here" if i % 2 else "bad bad stuff there", 0.5) for i in range(20)] + [(None, None, None), (3, "", 1.0), (3, "", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate double")
    labels = spark.createDataFrame([(i, "good" if i % 2 else "poor") for i in range(10)] + [(None, "good"), (1, None), (2, "other"), (1, "good")], "doc_id long, domain string")
    got = mixing.mixed(docs, labels, {"good": 0.8, "poor": 0.2}).collect()
    assert len(got) == 23 and all(0 <= r.rate <= 4 for r in got)
    assert {r.tokens for r in got} == {0, 4}
    assert mixing.mixed(docs.limit(0), labels, {"good": 1.0}).collect() == []


def test_labels_that_say_nothing(spark):
    """No labels, labels of other documents, of one domain, or of empty texts: defined posteriors, and no crash."""
    docs = spark.createDataFrame([(i, f"word w{i} here") for i in range(20)] + [(90, ""), (91, None)], "doc_id long, text string")
    for labels in ([], [(777, "good")], [(1, None)]):
        with pytest.warns(mixing.MixWarning, match="as likely"):
            got = mixing.mixed(docs, spark.createDataFrame(labels, "doc_id long, domain string"), {"good": 1.0, "poor": 1.0}).collect()
        assert len(got) == 22 and {(r.p_good, r.p_poor) for r in got} == {(0.5, 0.5)}
    with pytest.warns(mixing.MixWarning, match="misses"):
        got = mixing.mixed(docs, spark.createDataFrame([(1, "good"), (2, "good")], "doc_id long, domain string"), {"good": 1.0, "poor": 1.0}).collect()
    assert {(r.p_good, r.p_poor) for r in got} == {(1.0, 0.0)}
    got = mixing.mixed(docs, spark.createDataFrame([(90, "good"), (91, "poor")], "doc_id long, domain string"), {"good": 1.0, "poor": 1.0}).collect()
    assert {(r.p_good, r.p_poor) for r in got} == {(0.5, 0.5)}


def test_labels_of_absent_documents_take_no_place(spark):
    docs = spark.createDataFrame([(i, "fine good words" if i % 2 else "bad awful stuff") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, "good" if i % 2 else "poor") for i in [*range(40), *range(1000, 3000)]], "doc_id long, domain string")
    got = mixing.mixed(docs, labels, {"good": 1.0, "poor": 1.0}, trained_on=30).collect()
    assert all((r.p_good > 0.5) == (r.doc_id % 2 == 1) for r in got)


def test_drawn_rows_whatever_the_cores_and_columns(spark, tmp_path):
    """Planned with six tasks, collected with two; a caller's columns may have any names."""
    rows = [(None if i % 3 == 0 else i, "fine good words here" if i % 2 else "bad bad stuff there", i, i, "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, _copy int, toss string").repartition(6)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    labels = spark.createDataFrame([(i, "good" if i % 2 else "poor") for i in range(300)], "doc_id long, domain string")
    name = "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set(name, 6)
    try:
        drawn = mixing.drawn(docs, labels, {"good": 0.9, "poor": 0.1})
        spark.conf.set(name, 2)
        got = drawn.collect()
    finally:
        spark.conf.unset(name)
    assert drawn.columns == docs.columns
    good = sum(r.text.startswith("fine") for r in got)
    assert 0.87 * len(got) < good < 0.93 * len(got) and 250 < len(got) < 350
    assert len({r._row for r in got if r.text.startswith("fine")}) == 150  # each good row is drawn
    assert all(r._copy == r._row and (r.doc_id is None) == (r._row % 3 == 0) for r in got)


@pytest.fixture(scope="module")
def rare(spark):
    """400 documents of one length, one in fifty of them poor."""
    docs = spark.createDataFrame([(i, "bad stuff over there" if i % 50 == 0 else "fine good words here") for i in range(400)], "doc_id long, text string").cache()
    return docs, docs.selectExpr("doc_id", "if(doc_id % 50 = 0, 'poor', 'good') AS domain")


def test_a_rare_domain_reaches_its_target(rare, recwarn):
    seen = []
    got = mixing.mixed(*rare, {"good": 0.8, "poor": 0.2}, report=lambda shares, whole: seen.append((shares, whole))).collect()
    (shares, whole), = seen
    assert whole == 1600 and [s.domain for s in shares] == ["good", "poor"]
    for s in shares:
        assert s.reached == pytest.approx(sum(r.rate * r.tokens * r[f"p_{s.domain}"] for r in got), rel=1e-3)
        assert abs(s.reached - s.target) < mixing.MISSED * whole
    assert max(r.rate for r in got) > 5 and not [w for w in recwarn if w.category is mixing.MixWarning]


def test_a_missed_target_and_steps_without_end_are_said(rare, monkeypatch):
    with pytest.warns(mixing.MixWarning, match="poor: .* of 320"):
        mixing.mixed(*rare, {"good": 0.8, "poor": 0.2}, most=4.0)
    monkeypatch.setattr(mixing, "STEPS", 1)
    with pytest.warns(mixing.MixWarning, match="after 1 steps"):
        mixing.mixed(*rare, {"good": 0.8, "poor": 0.2})
