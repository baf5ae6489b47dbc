"""The pipeline's stages in a row, each against what its operator says on the stage's own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import mixing, pii, quality, simhash
from ledgerlake.llm.common import staged, table
from tests.llm.test_pii import plain_spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "mixture", "sequences"]
    assert all(d.columns == steps[0].columns for d in steps[:5])


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_quality(steps):
    assert ids(steps[1]) == sorted(r.doc_id for r in quality.judged(steps[0]).collect() if r.kept)
    assert 0 < len(ids(steps[1])) < steps[0].count()


def test_near_duplicates(steps):
    found = simhash.near_duplicates(steps[1]).collect()
    assert ids(steps[2]) == sorted({r.component_id for r in found}) and len(ids(steps[2])) < len(found)


def test_personal_data(steps):
    before = {r.doc_id: r.text for r in steps[2].collect()}
    after = {r.doc_id: r for r in steps[3].collect()}
    assert set(before) == set(after)
    for d, text in before.items():
        assert after[d].n_chars == len(after[d].text)
        if not pii.HINT.search(text):
            assert after[d].text == text
        assert not plain_spans(after[d].text)


def test_mixture(spark, steps):
    labels = mixing.domains_of(table(spark, SF, "labels"))
    copies = {r.doc_id: r.copies for r in mixing.mixed(steps[3], labels, corpus_pipeline.WEIGHTS).collect()}
    drawn = {r.doc_id: r["count"] for r in steps[4].groupBy("doc_id").count().collect()}
    assert drawn == {d: c for d, c in copies.items() if c}
    good = {r.doc_id for r in labels.filter("domain = 'good'").collect()} & set(ids(steps[3]))
    assert len(good & set(drawn)) >= 0.95 * len(good)


def test_sequences(steps):
    pieces = steps[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(p.sequence_id for p in pieces) == list(range(len(pieces)))
    assert sum(p.n < 2048 for p in pieces) <= 1


def test_stages_on_empty_and_ragged_tables(spark, steps, tmp_path):
    docs = steps[0]
    rows = docs.filter("doc_id < 30").unionByName(docs.filter("doc_id < 3")).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    ragged = rows.unionByName(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long"))).withColumn("kept", F.lit(1)).withColumn("row", F.lit("x"))
    for start in (docs.limit(0), ragged):
        current = start
        for name, stage in corpus_pipeline.STAGES:
            current = staged(stage(spark, current, SF), f"test-{name}")
            assert name == "sequences" or current.columns == start.columns


def test_quality_goes_by_row(spark, steps):
    """Rows without a doc_id stay if they are clean, and a rejected row goes although its doc_id is kept elsewhere."""
    third = F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") - F.col("doc_id") % 3)
    docs = staged(steps[0].withColumn("doc_id", third), "test-rows")
    verdicts = quality.judged(docs).collect()
    got = corpus_pipeline.quality_rules(spark, docs, SF)
    assert got.columns == docs.columns
    want = sorted(str(r.doc_id) for r in verdicts if r.kept)
    assert sorted(str(r.doc_id) for r in got.collect()) == want
    assert 0 < want.count("None") < sum(r.doc_id is None for r in verdicts)
    kept = {r.doc_id for r in verdicts if r.kept}
    assert any(not r.kept and r.doc_id in kept for r in verdicts if r.doc_id is not None)
