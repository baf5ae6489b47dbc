"""B, L, G, Q, M, T, P, U2 and ST2 on hand-written records and on the small tables."""

from datetime import date, datetime

import pytest
from conftest import final_plan, plan_of, rows
from pyspark.sql import functions as F

from ledgerlake import adapters
from ledgerlake.operators import checks
from ledgerlake.plans import assertions, incremental, marts, metrics, reports, silver, warehouse
from ledgerlake.session import scratch_dir
from ledgerlake.streaming.revert_join import claims_with_earliest_revert, claims_with_reverts


def ts(text):
    return datetime.fromisoformat(text)


CLAIMS = [
    # id, npi, ndc, price, quantity, fee, filled
    ("flat", "1", "d1", 100.0, 10.0, 5.0, "2026-03-10T10:00:00"),
    ("capped", "1", "d1", 100.0, 10.0, 0.5, "2026-03-10T11:00:00"),
    ("share", "2", "d1", 50.0, 5.0, 10.0, "2026-03-01T00:59:00"),
    ("twice", "2", "d2", 80.0, 4.0, 6.0, "2026-03-12T23:30:00"),
    ("nobody", "1", "d1", 20.0, 1.0, 30.0, "2026-02-01T08:00:00"),
    ("copy", "1", "d1", 11.0, 1.0, 1.0, "2026-03-02T08:00:00"),
    ("copy", "2", "d2", 12.0, 2.0, 2.0, "2026-03-01T08:00:00"),
    ("foreign", "9", "d1", 33.0, 1.0, 1.0, "2026-03-03T08:00:00"),
]
REVERTS = [
    ("r1", "twice", "2026-03-15T00:10:00"),
    ("r0", "twice", "2026-03-16T00:10:00"),
    ("r2", "share", "2026-03-01T01:01:00"),
    ("r3", "copy", "2026-03-09T01:01:00"),
    ("r4", "no such claim", "2026-03-09T01:01:00"),
]
LOOKUPS = [
    ("l1", "flat", "d1", "Flat", " Website", "2026-03-10T09:59:30"),
    ("l2", "capped", "d1", "Flat", "APP", "2026-03-10T10:30:00"),
    ("l3", "share", "d1", "Share", "", "2026-03-01T00:00:00"),
    ("l5", "twice", "d2", "Share", "fax", "2026-03-12T22:00:00"),
    ("l4", "twice", "d2", "Zero", "fax", "2026-03-12T22:00:00"),
    ("l6", None, "d3", "Both", "  ", "2026-03-20T22:00:00"),
    ("l7", "copy", "d3", "Stranger", "fax", "2026-01-20T22:00:00"),
]
PARTNERS = [("Flat", 100.0, None), ("Share", None, 80.0), ("Zero", 0.0, None), ("Both", 25.0, 10.0)]
PRICES = [
    # code, unit cost, effective, as of
    ("d1", 2.0, "2026-02-10", "2026-02-15"),
    ("d1", 9.0, "2026-02-01", "2026-02-15"),
    ("d1", 3.0, "2026-03-05", "2026-03-10"),
    ("d1", 4.0, "2026-03-30", "2026-04-01"),
    ("d1", 7.0, "2026-03-30", None),
]


@pytest.fixture(scope="module")
def landed(spark):
    def frame(data, schema):
        return spark.createDataFrame(data, schema).withColumn("source_file", F.lit("f")).withColumn("load_id", F.lit("1"))

    def day(text):
        return date.fromisoformat(text) if text else None

    reject = [("x", "negative_price", "f", "1")]
    return {
        "claims": frame(
            [(*c[:6], ts(c[6])) for c in CLAIMS],
            "claim_id string, npi string, ndc string, price double, quantity double, pbm_fee double, filled_at timestamp_ntz",
        ),
        "reverts": frame([(a, b, ts(c)) for a, b, c in REVERTS], "revert_id string, claim_id string, reverted_at timestamp_ntz"),
        "lookups": frame(
            [(*r[:5], ts(r[5])) for r in LOOKUPS],
            "lookup_id string, claim_id string, ndc string, partner string, channel string, looked_up_at timestamp_ntz",
        ),
        "pharmacies": frame([("1", " North "), ("2", "SOUTH")], "npi string, chain string"),
        "partners": frame(PARTNERS, "partner string, fee_cents double, fee_percentage double"),
        "nadac": frame(
            [(c, f"drug {c}", u, day(e), day(a), "EA", "G" if c == "d1" else "B", False) for c, u, e, a in PRICES],
            "ndc string, ndc_description string, nadac_per_unit double, effective_date date, as_of_date date, "
            "pricing_unit string, rate_setting_class string, is_otc boolean",
        ),
        "claims_rejects": spark.createDataFrame(reject, "raw_payload string, reject_reason string, source_file string, load_id string"),
    }


@pytest.fixture(scope="module")
def w(landed):
    return warehouse.Warehouse(landed)


@pytest.fixture(scope="module")
def facts(w):
    return {r.claim_id: r for r in w.fct_claim.collect()}


def test_b1_b2_b7_flags_drop_nothing(w):
    assert rows(w.brz_claims.filter("flag_duplicate_claim_id").select("claim_id", "claim_id_occurrences")) == [("copy", 2)] * 2
    assert rows(w.brz_claims.filter("flag_fee_exceeds_price").select("claim_id")) == [("nobody",)]
    assert w.brz_claims.count() == len(CLAIMS)
    channels = {r.lookup_id: (r.channel_raw, r.channel, r.flag_missing_channel) for r in w.brz_lookups.collect()}
    assert channels["l1"] == (" Website", "website", False)
    assert channels["l3"] == ("", "unknown", True) and channels["l6"] == ("  ", "unknown", True)
    order = rows(w.brz_reverts.select("claim_id", "revert_sequence", "revert_id", "flag_multiple_reverts"))
    assert order[-2:] == [("twice", 1, "r1", True), ("twice", 2, "r0", True)]


def test_l2_l5_l7(w):
    assert rows(w.slv_claims.select("claim_id", "chain")) == [
        ("capped", "north"), ("flat", "north"), ("nobody", "north"), ("share", "south"), ("twice", "south")
    ]
    assert rows(w.slv_partners.select("partner", "fee_type")) == [("Flat", "flat"), ("Share", "percentage"), ("Zero", "flat")]
    assert rows(w.slv_reverts.select("revert_id")) == [("r1",), ("r2",)]


def test_l3_unknown_partners_stay(w):
    assert rows(w.slv_lookups.filter("flag_unknown_partner").select("partner")) == [("Both",), ("Stranger",)]


def test_g5_money(facts):
    assert set(facts) == {"flat", "capped", "share", "twice", "nobody"}
    flat, capped, share, twice, nobody = (facts[k] for k in ("flat", "capped", "share", "twice", "nobody"))
    assert (flat.partner_fee, flat.retained_margin, flat.drug_cost, flat.pharmacy_margin) == (1.0, 4.0, 30.0, 65.0)
    assert (capped.partner_fee, capped.retained_margin) == (0.5, 0.0)
    assert (share.partner_fee, share.nadac_per_unit, share.cost_as_of_date) == (8.0, 2.0, date(2026, 2, 15))
    assert (twice.partner, twice.partner_fee, twice.flag_cost_unavailable) == ("Zero", 0.0, True)
    assert (nobody.partner, nobody.partner_fee, nobody.fee_type, nobody.drug_cost) == (None, 0.0, None, None)
    assert nobody.flag_cost_unavailable and nobody.net_drug_cost is None and nobody.net_pharmacy_margin is None


def test_g5_times_and_reversal(facts):
    share, twice = facts["share"], facts["twice"]
    assert share.is_reverted and share.hours_to_revert == 1 and share.minutes_lookup_to_fill == 59
    assert twice.is_reverted and twice.reverted_at == ts("2026-03-15T00:10:00") and twice.hours_to_revert == 49
    assert facts["flat"].minutes_lookup_to_fill == 1
    nets = [c for c in share.asDict() if c.startswith("net_")]
    assert len(nets) == 8 and all(share[c] == 0 and twice[c] == 0 for c in nets)
    assert facts["flat"].net_revenue == 100.0 and facts["flat"].net_fills == 1


def test_g6_lookups(w):
    found = {r.lookup_id: r for r in w.fct_lookup.collect()}
    assert set(found) == {r[0] for r in LOOKUPS}
    assert found["l7"].converted and not found["l7"].converted_to_valid_claim and found["l7"].net_revenue is None
    assert not found["l6"].converted and found["l6"].minutes_to_fill is None
    assert found["l4"].converted_to_valid_claim and found["l5"].is_reverted and found["l5"].net_revenue == 0
    assert found["l1"].net_retained_margin == 4.0 and found["l1"].chain == "north"
    assert w.fct_lookup.columns == [
        "lookup_id", "claim_id", "ndc", "partner", "channel", "date_day", "looked_up_at", "converted",
        "converted_to_valid_claim", "flag_unknown_partner", "chain", "is_reverted", "net_revenue", "net_pbm_fee",
        "net_retained_margin", "minutes_to_fill",
    ]
    assert len(w.fct_claim.columns) == 35


def test_g1_g2_dimensions(w):
    days = w.dim_date.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert tuple(days) == (date(2026, 1, 20), date(2026, 3, 20), 60)
    drugs = {r.ndc: (r.is_missing_from_nadac, r.is_generic) for r in w.dim_drug.collect()}
    assert drugs == {"d1": (False, True), "d2": (True, None), "d3": (True, None)}


def test_l9_latest_and_u2(landed):
    latest = warehouse.Warehouse(landed, warehouse.Policies(cost_basis="latest"))
    assert {r.claim_id: r.nadac_per_unit for r in latest.slv_claim_costs.collect()} == {
        "flat": 4.0, "capped": 4.0, "share": 4.0, "nobody": 4.0, "twice": None
    }
    kept = warehouse.Warehouse(landed, warehouse.Policies(duplicate_claims="keep_earliest"))
    assert rows(kept.slv_claims.filter("claim_id = 'copy'").select("price")) == [(12.0,)]
    for wrong in ({"duplicate_claims": "guess"}, {"cost_basis": "mean"}):
        with pytest.raises(ValueError):
            warehouse.Policies(**wrong)


def test_q1_q3_q5_q6(w):
    value = {r.partner: r for r in reports.partner_value(w.fct_claim, "north").collect()}
    assert value["Flat"].claims == 2 and value["Flat"].paid_to_partner == 1.5 and value["Flat"].pct_of_fee_paid_out == 27.3
    ledger = rows(reports.data_quality(w.brz_rejects, w.brz_claims, w.slv_pharmacies))
    assert ledger == [
        ("excluded in silver", "claims", "duplicate_claim_id", 2),
        ("excluded in silver", "claims", "pharmacy_not_in_reference", 1),
        ("rejected at ingest", "claims", "negative_price", 1),
    ]
    scenario = {r.partner: r for r in reports.fee_term_scenario(w.fct_claim, w.dim_partner, 2.0).collect()}
    assert (scenario["Flat"].paid_now, scenario["Flat"].paid_if_flat, scenario["Flat"].gain) == (1.5, 4.0, -2.5)
    assert rows(reports.exclusion_cost(w.brz_claims)) == [(2, 23.0)]


def test_empty_inputs_give_empty_facts(landed):
    empty = warehouse.Warehouse({name: t.limit(0) for name, t in landed.items()})
    assert empty.fct_claim.count() == 0 and empty.fct_lookup.count() == 0 and empty.dim_date.count() == 0
    assert reports.conversion_funnel(empty.fct_lookup).count() == 0
    assert rows(metrics.measure(empty.fct_claim, {"x": metrics.claim_metrics()["fee_payout_ratio"]})) == [(None,)]


@pytest.fixture(scope="module")
def small(spark, sf_dir):
    return warehouse.Warehouse(adapters.Landing(spark, sf_dir))


def test_t_all_pass_on_the_small_tables(small):
    s = small
    empty = {
        "unique": checks.unique(s.fct_claim, "claim_id"),
        "not null": checks.not_null(s.fct_claim, "date_day"),
        "npi": checks.relationships(s.fct_claim, "npi", s.dim_pharmacy, "npi"),
        "ndc": checks.relationships(s.fct_lookup, "ndc", s.dim_drug, "ndc"),
        "day": checks.relationships(s.fct_lookup, "date_day", s.dim_date, "date_day"),
        "partner": checks.relationships(s.fct_claim, "partner", s.dim_partner.unionByName(s.dim_partner.limit(1).withColumn("partner", F.lit("MACHINERY"))), "partner"),
        "kinds": checks.accepted_values(s.dim_partner, "fee_type", ["flat", "percentage"]),
        "series": checks.unique_combination(s.slv_nadac, ["ndc", "as_of_date"]),
        "T9": assertions.fee_identity(s.fct_claim),
        "T10": assertions.snapshots_loaded(s.brz_nadac),
        "T11": assertions.partner_fee_within_fee(s.fct_claim),
        "T12": assertions.partner_terms_exclusive(s.dim_partner),
        "T13": assertions.reverted_count_nothing(s.fct_claim),
        "T14": assertions.reverts_follow_fills(s.fct_claim),
        "T15": assertions.acceptance(s.fct_claim, s.fct_lookup, s.slv_claims, s.slv_claim_costs, s.slv_lookups).filter("misses <> 0"),
        "T16 flat": assertions.flat_term_in_dollars(s.fct_claim, s.dim_partner),
        "T16 share": assertions.percentage_term_share(s.fct_claim, s.dim_partner),
        "T16 zero": assertions.zero_term_partners(s.fct_claim, s.dim_partner),
    }
    assert {name: df.count() for name, df in empty.items() if df.count()} == {}


@pytest.mark.parametrize("policy", ["quarantine_all", "keep_earliest"])
def test_t7_p5_everything_is_accounted_for(spark, sf_dir, policy):
    s = warehouse.Warehouse(adapters.Landing(spark, sf_dir), warehouse.Policies(duplicate_claims=policy))
    broken = assertions.bronze_reconciles_to_silver(s.brz_claims, s.resolved_claims, s.slv_claims, s.slv_pharmacies)
    assert broken.count() == 0
    ledger = marts.gld_revenue_reconciliation(s.brz_claims, s.landing["claims_rejects"], s.resolved_claims, s.slv_pharmacies, s.fct_claim)
    found = {r.stage: r for r in ledger.collect()}
    parts = [r for stage, r in found.items() if stage not in ("landed", "rejected at ingest")]
    assert sum(r.claims for r in parts) == found["landed"].claims
    assert sum(r.gross_price for r in parts) == pytest.approx(found["landed"].gross_price)
    assert found["rejected at ingest"].gross_price is None


def test_p1_p2_marts_add_up(small):
    by_month = marts.gld_partner_performance(small.fct_claim).agg(F.sum("revenue"), F.sum("fills")).first()
    assert by_month[0] == pytest.approx(small.fct_claim.agg(F.sum("net_revenue")).first()[0])
    assert marts.gld_conversion_funnel(small.fct_lookup).agg(F.sum("lookups")).first()[0] == small.fct_lookup.count()


def test_l1_policies_are_nested(spark, sf_dir):
    kept = {
        p: warehouse.Warehouse(adapters.Landing(spark, sf_dir), warehouse.Policies(duplicate_claims=p)).slv_claims
        for p in ("quarantine_all", "keep_earliest")
    }
    assert kept["quarantine_all"].join(kept["keep_earliest"], "claim_id", "left_anti").count() == 0


def split(landed, cutoff):
    """What was known before the cutoff, and the rest."""
    known, fresh = dict(landed), dict(landed)
    for stream, time in (("claims", "filled_at"), ("reverts", "reverted_at"), ("lookups", "looked_up_at")):
        before = F.col(time) < F.lit(cutoff).cast("timestamp_ntz")
        known[stream], fresh[stream] = landed[stream].filter(before), landed[stream].filter(~before)
    return known, fresh


@pytest.mark.parametrize("grain", ["day", "month"])
@pytest.mark.parametrize("cutoff", ["2026-03-02", "2026-03-12", "2026-04-01"])
def test_p4_refresh_equals_full_build(spark, landed, w, grain, cutoff):
    known, fresh = split(landed, cutoff)
    name = scratch_dir(spark, "db")
    database = name.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{name}'")
    table = f"{database}.fct_claim"
    incremental.store_fct_claim(warehouse.Warehouse(known).fct_claim, table, grain)
    stored_before = {r.claim_id for r in spark.table(table).collect()}
    for _ in range(2):
        incremental.refresh_fct_claim(spark, table, known, fresh, grain)
        assert rows(spark.table(table).select(*w.fct_claim.columns)) == rows(w.fct_claim)
    if cutoff == "2026-03-02":
        # One copy of the id was known and valid; the other arrives later, so it must vanish.
        assert "copy" in stored_before
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_p4_touches_only_affected_days(spark, landed):
    known, fresh = split(landed, "2026-03-12")
    days = {r[0] for r in incremental.affected_periods(known, fresh).collect()}
    assert days == {date(2026, 3, 12)}
    late_revert = {**fresh, "reverts": landed["reverts"]}
    days = {r[0] for r in incremental.affected_periods(known, late_revert).collect()}
    assert days == {date(2026, 3, 1), date(2026, 3, 2), date(2026, 3, 12)}


def test_p4_claims_are_limited_before_ids_are_compared(spark, landed):
    """Nothing but the id column of the landing meets the collision step outside the periods."""
    periods = spark.createDataFrame([(date(2026, 3, 2),)], f"{incremental.PERIOD} date")
    for policy in ("quarantine_all", "keep_earliest"):
        policies = warehouse.Policies(duplicate_claims=policy)
        part = incremental.fct_claim_of_periods(landed, periods, policies=policies)
        whole = warehouse.Warehouse(landed, policies).fct_claim.filter("date_day = DATE'2026-03-02'")
        assert rows(part) == rows(whole)
    resolved = incremental._PeriodWarehouse(landed, warehouse.Policies(), periods, "day").resolved_claims
    plan = resolved._jdf.queryExecution().optimizedPlan().toString()
    anti = plan[plan.index("LeftAnti") :]
    assert "LeftSemi" in anti[: anti.index("Aggregate")]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_p4_late_revert_reaches_both_facts(spark, landed, w, grain):
    """A revert of the oldest claim, however late, changes its claim and the lookup that led to it."""
    known, fresh = split(landed, "2026-03-12")
    known["reverts"], fresh["reverts"] = landed["reverts"].limit(0), landed["reverts"]
    name = scratch_dir(spark, "db")
    database = name.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{name}'")
    claims, lookups = f"{database}.fct_claim", f"{database}.fct_lookup"
    before = warehouse.Warehouse(known)
    incremental.store_fct_claim(before.fct_claim, claims, grain)
    incremental.store_fct_claim(before.fct_lookup, lookups, grain)
    incremental.refresh_fct_claim(spark, claims, known, fresh, grain, lookup_table=lookups)
    assert rows(spark.table(claims).select(*w.fct_claim.columns)) == rows(w.fct_claim)
    assert rows(spark.table(lookups).select(*w.fct_lookup.columns)) == rows(w.fct_lookup)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_p6_stale_streams(w):
    streams = {
        "claims": (w.landing["claims"], "filled_at"),
        "lookups": (w.landing["lookups"], "looked_up_at"),
        "none": (w.landing["reverts"].limit(0), "reverted_at"),
    }
    late = assertions.stale_streams(streams, "2026-03-21T00:00:00", 48)
    assert rows(late) == [("claims", ts("2026-03-12T23:30:00")), ("none", None)]


def test_p4_lookback(w):
    assert incremental.lookback_suffices(w.fct_claim, 100).count() == 0
    assert rows(incremental.lookback_suffices(w.fct_claim, 60)) == [(49,)]


def test_k4_sql_over_the_layers(spark, landed, tmp_path):
    tables = warehouse.materialize(spark, warehouse.Warehouse(landed), str(tmp_path), prefix="k4_")
    got = spark.sql("SELECT sum(net_fills) FROM k4_gold.fct_claim JOIN dim_date USING (date_day) WHERE month_name = 'March'")
    assert got.first()[0] == 2
    assert spark.sql("SELECT count(*) FROM brz_claims").first()[0] == len(CLAIMS)
    # The dimensions and the lookup fact build on the stored claim fact, not on a second pricing.
    for name in ("dim_date", "dim_drug", "fct_lookup"):
        assert set(tables[name].columns) == set(getattr(warehouse.Warehouse(landed), name).columns)
    spark.sql("DROP DATABASE k4_gold CASCADE")


def test_k4_declared_tests_on_request(spark, landed, tmp_path):
    """The small example lacks price snapshots, and that is the first thing said."""
    with pytest.raises(ValueError, match="snapshots loaded"):
        warehouse.materialize(spark, warehouse.Warehouse(landed), str(tmp_path), prefix="tested_", test=True)
    spark.sql("DROP DATABASE tested_gold CASCADE")


def test_k4_gold_is_priced_once(spark, landed, tmp_path):
    w = warehouse.Warehouse(landed)
    for name in ("fct_claim", "fct_lookup"):
        getattr(w, name).write.parquet(str(tmp_path / name))
        w.replace(name, spark.read.parquet(str(tmp_path / name)))
    for name in ("dim_date", "dim_drug"):
        assert any("/fct_claim/" in f for f in getattr(w, name).inputFiles())
        assert "claim_id" not in plan_of(getattr(w, name))
        assert rows(getattr(w, name)) == rows(getattr(warehouse.Warehouse(landed), name))


def test_k4_every_layer_stored_under_its_name(spark, landed, tmp_path):
    all_layers = tuple(warehouse.LAYERS)
    for folder in ("first", "second"):
        warehouse.materialize(spark, warehouse.Warehouse(landed), str(tmp_path / folder), all_layers, "all_")
        for layer in all_layers:
            assert {t.name for t in spark.catalog.listTables(f"all_{layer}") if not t.isTemporary} == set(warehouse.LAYERS[layer])
        got = spark.sql(
            "SELECT b.claim_id FROM all_bronze.brz_claims b LEFT JOIN all_silver.slv_pharmacies p USING (npi) "
            "LEFT JOIN all_gold.fct_claim f ON f.claim_id = b.claim_id WHERE p.npi IS NULL AND f.claim_id IS NULL"
        )
        assert rows(got) == [("foreign",)]
    for layer in all_layers:
        spark.sql(f"DROP DATABASE all_{layer} CASCADE")


def test_st2_equals_the_batch_inside_the_lookback(spark, tmp_path, w):
    """The streams arrive in two steps; an unreverted claim appears once the watermark is past its lookback."""
    claims = w.slv_claims.select("claim_id", "filled_at")
    reverts = w.slv_reverts.select("claim_id", "revert_id", "reverted_at")
    end = spark.createDataFrame([("end", ts("2030-01-01T00:00:00"))], "claim_id string, at timestamp_ntz")
    paths = {name: str(tmp_path / name) for name in ("claims", "reverts", "out", "checkpoint")}

    def run():
        streams = [spark.readStream.schema(t.schema).parquet(paths[n]) for n, t in (("claims", claims), ("reverts", reverts))]
        joined = claims_with_reverts(*streams, "72 HOURS", "2 hours")
        sink = joined.writeStream.format("parquet").option("path", paths["out"]).option("checkpointLocation", paths["checkpoint"])
        sink.trigger(availableNow=True).start().awaitTermination()
        return {r.claim_id: r.revert_id for r in spark.read.parquet(paths["out"]).collect()}

    claims.write.parquet(paths["claims"])
    reverts.write.parquet(paths["reverts"])
    assert run().items() >= {"share": "r2", "twice": "r1"}.items()
    end.select("claim_id", F.col("at").alias("filled_at")).write.mode("append").parquet(paths["claims"])
    end.select("claim_id", F.lit("none").alias("revert_id"), F.col("at").alias("reverted_at")).write.mode("append").parquet(paths["reverts"])
    expected = {"share": "r2", "twice": "r1", "flat": None, "capped": None, "nobody": None}
    found = run()
    found.pop("end", None)
    assert found == expected


def test_st2_one_row_per_claim(spark, tmp_path):
    """A second revert after the delay adds nothing, and a revert before the fill hides no later one."""
    claims = [("twice", ts("2026-05-01T00:00:00")), ("early", ts("2026-05-02T00:00:00"))]
    reverts = [
        [("twice", "first", ts("2026-05-01T01:00:00")), ("early", "too soon", ts("2026-05-01T20:00:00"))],
        [("twice", "second", ts("2026-05-01T10:00:00")), ("early", "valid", ts("2026-05-02T03:00:00"))],
        [("end", "end", ts("2030-01-01T00:00:00"))],
    ]
    ends = [("end", ts("2030-01-01T00:00:00"))]
    schemas = {"claims": "claim_id string, filled_at timestamp_ntz", "reverts": "claim_id string, revert_id string, reverted_at timestamp_ntz"}
    paths = {name: str(tmp_path / name) for name in (*schemas, "out", "checkpoint")}
    for step, some in enumerate(reverts):
        spark.createDataFrame([claims, claims[:0], ends][step], schemas["claims"]).write.mode("append").parquet(paths["claims"])
        spark.createDataFrame(some, schemas["reverts"]).write.mode("append").parquet(paths["reverts"])
        streams = [spark.readStream.schema(schema).parquet(paths[name]) for name, schema in schemas.items()]
        joined = claims_with_reverts(*streams, "48 HOURS", "1 hour")
        sink = joined.writeStream.format("parquet").option("path", paths["out"]).option("checkpointLocation", paths["checkpoint"])
        sink.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(paths["out"]).filter("claim_id <> 'end'").select("claim_id", "revert_id", "is_reverted")
    assert rows(found) == [("early", "valid", True), ("twice", "first", True)]


def test_st2_earliest_revert_whatever_the_arrival(spark, tmp_path):
    """Reverts come in reverse order over three runs, some at one instant; claims wait for the end of their lookback."""
    claims = [("late", ts("2026-05-01T00:00:00")), ("tied", ts("2026-05-02T00:00:00")), ("none", ts("2026-05-02T00:00:00"))]
    early, last = ("late", "a", ts("2026-05-01T01:00:00")), ("late", "b", ts("2026-05-01T10:00:00"))
    reverts = [
        [last, ("tied", "y", ts("2026-05-02T02:00:00")), ("none", "outside", ts("2026-05-04T00:00:01"))],
        [early, early, ("tied", "x", ts("2026-05-02T02:00:00")), ("tied", "before", ts("2026-05-01T23:59:59"))],
        [("end", "end", ts("2030-01-01T00:00:00"))],
    ]
    ends = [("end", ts("2030-01-01T00:00:00"))]
    schemas = {"claims": "claim_id string, filled_at timestamp_ntz", "reverts": "claim_id string, revert_id string, reverted_at timestamp_ntz"}
    paths = {name: str(tmp_path / name) for name in (*schemas, "out", "checkpoint")}
    seen = []
    for step, some in enumerate(reverts):
        spark.createDataFrame([claims, claims[:1], ends][step], schemas["claims"]).write.mode("append").parquet(paths["claims"])
        spark.createDataFrame(some, schemas["reverts"]).write.mode("append").parquet(paths["reverts"])
        streams = [spark.readStream.schema(schema).parquet(paths[name]) for name, schema in schemas.items()]
        joined = claims_with_earliest_revert(*streams, "48 HOURS", "60 hours")
        sink = joined.writeStream.format("parquet").option("path", paths["out"]).option("checkpointLocation", paths["checkpoint"])
        sink.trigger(availableNow=True).start().awaitTermination()
        seen.append(rows(spark.read.schema(joined.schema).parquet(paths["out"]).filter("claim_id <> 'end'").drop("filled_at")))
    settled = [("late", "a", early[2], True), ("none", None, None, False), ("tied", "x", ts("2026-05-02T02:00:00"), True)]
    assert seen == [[], [], settled]


@pytest.mark.parametrize("name", ["slv_claims", "fct_claim", "fct_lookup", "dim_drug"])
def test_making_a_table_starts_no_job(spark, sf_dir, name):
    landing = adapters.Landing(spark, sf_dir)
    {stream: landing[stream] for stream in ("claims", "lookups", "reverts", "nadac", "partners", "pharmacies")}
    group = f"plan-only-{name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        getattr(warehouse.Warehouse(landing), name)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_l1_copies_that_differ_in_one_column_only(spark, landed):
    """The kept copy doesn't depend on the order of rows."""
    one = landed["claims"].limit(1)
    copies = [one.withColumn("price", F.lit(p).cast("double")) for p in (30.0, 10.0, 20.0)]
    kept = set()
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        stacked = copies[order[0]].union(copies[order[1]]).union(copies[order[2]])
        w = warehouse.Warehouse({**landed, "claims": stacked}, warehouse.Policies(duplicate_claims="keep_earliest"))
        kept |= {r.price for r in w.resolved_claims.collect()}
    assert kept == {10.0}


def test_p6_numbered_loads_come_in_order(spark):
    """With 12 loads of slowly growing size no load stands out from the four before it."""
    counts = [(str(i), n) for i in range(12) for n in range(100 + 5 * i)]
    clean = spark.createDataFrame(counts, "load_id string, n int")
    refused = spark.createDataFrame([], "stream string, load_id string")
    assert assertions.rejection_shifts(refused, {"claims": clean}, 4, 0.15).count() == 0
    assert assertions.rejection_shifts(refused, {"claims": clean.filter("load_id <> '7' OR n < 20")}, 4, 0.15).first().load_id == "7"


def test_plans_have_no_python_and_no_cross_join(small):
    for name in ("fct_claim", "fct_lookup", "dim_drug", "dim_date"):
        plan = plan_of(getattr(small, name))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_plans_shuffle_claims_once_per_key(spark, small):
    """Without broadcasts, the claims move once by id for three joins and once for the cost."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(warehouse.Warehouse(small.landing).fct_claim)
        lines = plan[: plan.index("Initial Plan")].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in lines if "Join [claim_id#" in line and "Broadcast" not in line]
    assert len(joins) == 3
    assert sum("Exchange hashpartitioning(ndc#" in line and "trunc(filled_date" in line for line in lines) == 1
    # Claims, id counts (made once and used twice), lookups and reverts; nothing is moved by a
    # bare partner, which may be hot or NULL. Without a hot id the count's first use folds away.
    moved = [line for line in lines if "Exchange hashpartitioning(claim_id#" in line]
    assert len([line for line in moved if "Reused" not in line]) <= 4
    assert len([line for line in moved if "Reused" in line]) == 1
    assert not any("Exchange hashpartitioning(partner" in line for line in lines)
    scans = [line for line in lines if "lineitem" in line]
    assert scans and not any("l_discount" in line or "l_linestatus" in line for line in scans)


def test_newest_prices_are_not_broadcast(spark):
    """A row per code: compressed they look small, and would go through the driver at many times that size."""
    claims = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "9")], "claim_id string, ndc string")
    dates = [("1", date(2000, 1, 1), 1.0), ("1", date(2000, 2, 1), 2.0), ("2", date(2000, 1, 1), 3.0)]
    prices = spark.createDataFrame(dates, "ndc string, as_of_date date, nadac_per_unit double")
    prices = prices.withColumns({"pricing_unit": F.lit("EA"), "is_generic": F.lit(True)})
    costed = silver.attach_costs(claims, prices, silver.LATEST)
    assert "BroadcastExchange" not in final_plan(costed)
    got = {r.claim_id: (r.nadac_per_unit, r.flag_cost_unavailable) for r in costed.collect()}
    assert got == {"a": (2.0, False), "b": (3.0, False), "c": (None, True), "d": (None, True)}
