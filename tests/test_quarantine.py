"""V1-V7, S1, K2, K3, X1, JS1, ST1: validation and routing of records."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerlake.operators.quarantine import CLAIMS, CONTRACTS, LOOKUPS, REVERTS, clean_rows, reject_rows, validate
from ledgerlake.sources import events, files, landing
from ledgerlake.streaming.quarantine_stream import start_quarantine

CLAIM = {
    "id": "fill-1",
    "npi": "1234567893",
    "ndc": "55555044410",
    "price": 18.0,
    "quantity": 12.5,
    "pbm_fee": 0.4,
    "timestamp": "2025-11-30T23:59:01",
}


def judge(spark, contract, *records):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return validate(spark.createDataFrame([(t,) for t in texts], "raw_payload string"), contract)


# What each rule refuses, and how rules go together: a missing field hides the others, a bad time hides
# numbers, numbers are listed together, and ranges are judged last, price before quantity.
ACCEPTED = [
    {},
    {"price": "18"},
    {"price": "1.8e1"},
    {"price": 0.0},
    {"quantity": "0.001"},
    {"pbm_fee": -7},
    {"ndc": ""},
    {"timestamp": "2025-11-30"},
    {"remark": {"deep": [None]}},
]
REFUSED = [
    ("missing_required_field:pbm_fee", {"pbm_fee": None}),
    ("missing_required_field:ndc,timestamp", {"ndc": None, "timestamp": None, "quantity": -4}),
    ("unparseable_timestamp", {"timestamp": "noon"}),
    ("unparseable_timestamp", {"timestamp": "2025-02-29T00:00:00"}),
    ("unparseable_timestamp", {"timestamp": 1764547141}),
    ("unparseable_timestamp", {"timestamp": " ", "pbm_fee": "free"}),
    ("non_numeric:pbm_fee", {"pbm_fee": "free"}),
    ("non_numeric:price", {"price": "1,800"}),
    ("non_numeric:price", {"price": "0x12"}),
    ("non_numeric:quantity", {"quantity": False}),
    ("non_numeric:quantity", {"quantity": {"n": 3}}),
    ("non_numeric:price,pbm_fee", {"price": "", "pbm_fee": [], "quantity": -1}),
    ("negative_price", {"price": "-0.01"}),
    ("negative_price", {"price": -2, "quantity": -2}),
    ("non_positive_quantity", {"quantity": "0"}),
    ("non_positive_quantity", {"quantity": -0.5, "price": 0}),
]


def test_v4_claims(spark):
    changes = [(None, c) for c in ACCEPTED] + REFUSED
    judged = judge(spark, CLAIMS, *({**CLAIM, **c, "id": str(i)} for i, (_, c) in enumerate(changes)))
    found = {json.loads(r.raw_payload)["id"]: r.reject_reason for r in judged.collect()}
    assert [(found[str(i)], c) for i, (_, c) in enumerate(changes)] == changes


def test_v1_absent_key_counts_as_missing(spark):
    short = {k: v for k, v in CLAIM.items() if k not in ("timestamp", "npi")}
    assert judge(spark, CLAIMS, short).first().reject_reason == "missing_required_field:npi,timestamp"


def test_v7_typed_and_renamed(spark):
    row = clean_rows(judge(spark, CLAIMS, {**CLAIM, "price": "\t18.00 ", "npi": 1234567893}), CLAIMS).first()
    assert row.asDict() == {
        "claim_id": "fill-1", "npi": "1234567893", "ndc": "55555044410", "price": 18.0, "quantity": 12.5, "pbm_fee": 0.4,
        "filled_at": row.filled_at,
    }
    assert row.filled_at.isoformat() == "2025-11-30T23:59:01"


def test_v5_revert_needs_its_claim(spark):
    good = {"id": "void-1", "claim_id": "fill-1", "timestamp": "2025-12-24T18:00:00"}
    reasons = [r.reject_reason for r in judge(spark, REVERTS, good, {**good, "claim_id": None}).collect()]
    assert reasons == [None, "missing_required_field:claim_id"]


def test_v6_lookup_needs_no_claim_and_no_channel_text(spark):
    good = {"id": "ask-1", "claim_id": None, "ndc": "1", "partner": "p", "channel": "", "timestamp": "2025-12-24T17:45:00"}
    without = {k: v for k, v in good.items() if k != "claim_id"}
    reasons = [r.reject_reason for r in judge(spark, LOOKUPS, good, without, {**good, "channel": None}).collect()]
    assert reasons == [None, None, "missing_required_field:channel"]


def test_rejects_keep_the_payload(spark):
    bad = json.dumps({**CLAIM, "price": "x", "note": "kept é"}, ensure_ascii=False)
    assert rows(reject_rows(judge(spark, CLAIMS, bad))) == [(bad, "non_numeric:price")]


def test_parsing_happens_once_below_a_filter_on_the_reason(spark):
    plan = clean_rows(judge(spark, CLAIMS, CLAIM), CLAIMS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.fixture
def folder(tmp_path):
    def claim(n, **change):
        return {**CLAIM, "id": f"c{n}", **change}

    files = {
        "a_array.json": json.dumps([claim(1), claim(2, price="x"), 7, None, "text", [claim(3)], claim(4)], indent=1),
        "b_single.json": "  " + json.dumps(claim(5)) + "\n",
        "c_cut.json": json.dumps([claim(6), claim(7)])[:-9],
        "d_scalar.json": "17",
        "e_empty_array.json": "[]",
        "f_words.json": "no json here",
        "g_braces.json": json.dumps([claim(8, ndc='],[{"')]),
        "ignored.txt": json.dumps(claim(9)),
    }
    source = tmp_path / "claims"
    (source / "below").mkdir(parents=True)
    for name, text in files.items():
        (source / name).write_text(text)
    (source / "below" / "deep.json").write_text(json.dumps(claim(10)))
    return str(source)


EXPECTED_CLEAN = [("c1", "a_array.json"), ("c4", "a_array.json"), ("c5", "b_single.json"), ("c8", "g_braces.json")]
EXPECTED_REJECTS = [
    ("non_numeric:price", "a_array.json"), ("unreadable_file", "c_cut.json"), ("unreadable_file", "f_words.json")
]


def test_s1_x1_json_folder(spark, folder):
    judged = events.validated_stream(spark, folder, "claims", "load-3")
    assert rows(judged.filter("reject_reason IS NULL").select("claim_id", "source_file")) == EXPECTED_CLEAN
    assert rows(judged.filter("reject_reason IS NOT NULL").select("reject_reason", "source_file")) == EXPECTED_REJECTS
    assert rows(judged.select("load_id").distinct()) == [("load-3",)]


def test_s1_array_larger_than_any_variant(spark, tmp_path):
    text = json.dumps([{**CLAIM, "id": f"c{i}", "note": "x" * 2000} for i in range(10_000)])
    assert len(text) > 20_000_000
    (tmp_path / "big.json").write_text(text)
    assert events.read_json_dir(spark, str(tmp_path)).count() == 10_000


def test_k2_k3_routing(spark, folder, tmp_path):
    target = str(tmp_path / "landing")
    loaded = landing.ingest(spark, {"claims": folder}, target, "007")
    assert rows(loaded["claims"].select("claim_id", "source_file", "load_id")) == [(*r, "007") for r in EXPECTED_CLEAN]
    assert rows(loaded["claims_rejects"].select("reject_reason", "source_file")) == EXPECTED_REJECTS


def test_k2_all_clean_and_all_refused(spark, tmp_path):
    for name, record in (("clean", CLAIM), ("refused", {**CLAIM, "price": "x"})):
        judged = judge(spark, CLAIMS, record).withColumn("source_file", F.lit("f")).withColumn("load_id", F.lit("1"))
        landing.write_quarantine(judged, str(tmp_path / name))
        tables = landing.read_quarantine(spark, str(tmp_path / name), "claims")
        assert (tables["claims"].count(), tables["claims_rejects"].count()) == ((1, 0) if name == "clean" else (0, 1))


def test_st1_equals_the_batch_and_resumes(spark, folder, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start_quarantine(spark, folder, "claims", target, checkpoint).awaitTermination()
    (tmp_path / "claims" / "h_late.json").write_text(json.dumps({**CLAIM, "id": "c11"}))
    start_quarantine(spark, folder, "claims", target, checkpoint).awaitTermination()
    tables = landing.read_quarantine(spark, target, "claims")
    assert rows(tables["claims"].select("claim_id", "source_file")) == sorted([*EXPECTED_CLEAN, ("c11", "h_late.json")])
    assert rows(tables["claims_rejects"].select("reject_reason", "source_file")) == EXPECTED_REJECTS
    assert rows(tables["claims"].filter("claim_id = 'c11'").select("load_id")) == [("1",)]


def test_st1_in_small_batches(spark, folder, tmp_path):
    target = str(tmp_path / "out")
    start_quarantine(spark, folder, "claims", target, str(tmp_path / "cp"), files_per_batch=2).awaitTermination()
    tables = landing.read_quarantine(spark, target, "claims")
    assert rows(tables["claims"].select("claim_id", "source_file")) == EXPECTED_CLEAN
    assert rows(tables["claims_rejects"].select("reject_reason", "source_file")) == EXPECTED_REJECTS


def test_contracts_name_every_stream():
    assert set(CONTRACTS) == set(landing.EVENT_SOURCES)


def test_a_folder_is_not_listed_by_the_driver(spark, tmp_path, monkeypatch):
    """Only a folder with a hidden or a large file is gone through name by name."""
    (tmp_path / "a.json").write_text('[{"id":"1"}]')
    (tmp_path / "_b.txt").write_text("no record")
    listed = []
    monkeypatch.setattr(events, "listed", lambda *a: listed.append(a) or files.listed(*a))
    assert events.read_json_dir(spark, str(tmp_path)).count() == 1 and not listed
    (tmp_path / "_c.json").write_text('{"id":"2"}')
    assert events.read_json_dir(spark, str(tmp_path)).count() == 2 and listed
