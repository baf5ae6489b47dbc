"""The saved reports over the gold, silver and bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import count_true, percent, round_ratio, round_total
from ledgerlake.operators.profile import quantile_profile

# Fixed value: rows of the drug report.
TOP_DRUGS = 25
# Fixed value: rows of a preview.
PREVIEW_ROWS = 200


def _total(column: str, name: str) -> Column:
    return round_total(F.sum(column)).alias(name)


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def partner_value(fct_claim: DataFrame, chain: str) -> DataFrame:
    """What each partner is worth to one chain: volume, revenue, fee and what is kept of it."""
    return (
        fct_claim.filter(F.col("chain") == chain)
        .groupBy("partner")
        .agg(
            _rows("claims"),
            F.sum("net_fills").alias("fills"),
            _total("net_revenue", "revenue"),
            _total("net_pbm_fee", "pbm_fee_collected"),
            _total("net_partner_fee", "paid_to_partner"),
            _total("net_retained_margin", "margin_retained"),
            round_ratio(percent(F.sum("net_partner_fee"), F.sum("net_pbm_fee")), 1).alias("pct_of_fee_paid_out"),
            round_ratio(percent(count_true(F.col("is_reverted")), F.count(F.lit(1))), 2).alias("revert_rate_pct"),
        )
        .orderBy(F.col("margin_retained").desc_nulls_last())
    )


def conversion_funnel(fct_lookup: DataFrame) -> DataFrame:
    """From lookup to claim to reversal, by partner and channel."""
    converted = count_true(F.col("converted_to_valid_claim"))
    reverted = count_true(F.col("is_reverted"))
    return (
        fct_lookup.groupBy("partner", "channel")
        .agg(
            _rows("lookups"),
            converted.alias("claims"),
            round_ratio(percent(converted, F.count(F.lit(1))), 2).alias("conversion_pct"),
            reverted.alias("reverted"),
            round_ratio(percent(reverted, converted), 2).alias("revert_rate_pct"),
            round_total(F.coalesce(F.sum("net_retained_margin"), F.lit(0.0))).alias("margin"),
        )
        .orderBy(F.col("lookups").desc())
    )


def data_quality(brz_rejects: DataFrame, brz_claims: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """Every exclusion with its reason and size, at ingest and in silver."""
    at_ingest = brz_rejects.groupBy("stream", F.col("reject_reason").alias("reason")).agg(_rows("records"))
    repeated = brz_claims.filter("claim_id_occurrences > 1").agg(_rows("records"))
    foreign = (
        brz_claims.filter("claim_id_occurrences = 1")
        .join(pharmacies.select("npi"), "npi", "left_anti")
        .agg(_rows("records"))
    )

    def in_silver(count: DataFrame, reason: str) -> DataFrame:
        return count.select(F.lit("claims").alias("stream"), F.lit(reason).alias("reason"), "records")

    excluded = in_silver(repeated, "duplicate_claim_id").unionByName(in_silver(foreign, "pharmacy_not_in_reference"))
    ledger = at_ingest.withColumn("stage", F.lit("rejected at ingest")).unionByName(
        excluded.withColumn("stage", F.lit("excluded in silver"))
    )
    return ledger.select("stage", "stream", "reason", "records").orderBy(
        F.col("stage").asc_nulls_last(), F.col("records").desc()
    )


def margin_by_drug(fct_claim: DataFrame, dim_drug: DataFrame, top: int = TOP_DRUGS) -> DataFrame:
    """The drugs that earn most, with cost, unit spread and claims that found no cost.

    The claims are summed per code before the drug names are joined. Spread is the mean over claims
    that have a cost. The code breaks ties of the margin.
    """
    per_code = fct_claim.groupBy("ndc").agg(
        _rows("claims"),
        _total("net_revenue", "revenue"),
        _total("net_drug_cost", "est_drug_cost"),
        _total("net_retained_margin", "retained_margin"),
        round_ratio(F.avg(F.col("unit_price") - F.col("nadac_per_unit")), 4).alias("avg_unit_spread"),
        count_true(F.col("flag_cost_unavailable")).alias("claims_without_cost"),
    )
    named = dim_drug.select("ndc", "ndc_description", "is_generic")
    return (
        per_code.join(named, "ndc")
        .select(
            "ndc",
            "ndc_description",
            "is_generic",
            "claims",
            "revenue",
            "est_drug_cost",
            "retained_margin",
            "avg_unit_spread",
            "claims_without_cost",
        )
        .orderBy(F.col("retained_margin").desc_nulls_last(), F.col("ndc"))
        .limit(top)
    )


def fee_term_scenario(fct_claim: DataFrame, dim_partner: DataFrame, flat: float = 1.0) -> DataFrame:
    """What each partner would be paid under one flat term per completed fill, in dollars."""
    per_partner = fct_claim.groupBy("partner").agg(
        F.sum("net_fills").alias("fills"),
        F.sum("net_pbm_fee").alias("_fee"),
        F.sum("net_partner_fee").alias("_paid"),
        F.sum("net_retained_margin").alias("_kept"),
    )
    at_flat = F.col("fills") * F.lit(float(flat))
    return (
        per_partner.join(dim_partner, "partner")
        .select(
            "partner",
            "fee_type",
            F.coalesce("fee_cents", "fee_percentage").alias("term"),
            "fills",
            round_total(F.col("_fee")).alias("fee_collected"),
            round_total(F.col("_paid")).alias("paid_now"),
            round_total(F.col("_kept")).alias("retained_now"),
            round_total(at_flat).alias("paid_if_flat"),
            round_total(F.col("_fee") - at_flat).alias("retained_if_flat"),
            round_total(F.col("_paid") - at_flat).alias("gain"),
        )
        .orderBy(F.col("gain").desc_nulls_last())
    )


def exclusion_cost(brz_claims: DataFrame) -> DataFrame:
    """How many claims share an id with another and what they are worth."""
    return brz_claims.filter("flag_duplicate_claim_id").agg(
        _rows("claims"), round_total(F.coalesce(F.sum("price"), F.lit(0.0))).alias("gross_price")
    )


def retained_by_partner(fct_claim: DataFrame) -> DataFrame:
    return (
        fct_claim.groupBy("partner")
        .agg(_total("net_retained_margin", "retained_margin"))
        .orderBy(F.col("retained_margin").desc_nulls_last())
    )


def preview(df: DataFrame, order: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a result in a stated order, each with the full row count beside it."""
    full = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(*order).limit(rows).withColumn("full_count", full)


def fee_quintiles(fct_claim: DataFrame) -> DataFrame:
    """Mean fee per fifth of the claims by price: flat if fees do not follow prices."""
    return quantile_profile(fct_claim, "price", "pbm_fee", 5)
