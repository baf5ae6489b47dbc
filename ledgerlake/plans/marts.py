"""Marts with fixed definitions over the facts, and the ledger of excluded value."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import count_true, ratio
from ledgerlake.plans.metrics import lookup_metrics


def _rows() -> Column:
    return F.count(F.lit(1))


def _month() -> Column:
    return F.trunc("date_day", "month").alias("month_start")


def gld_partner_performance(fct_claim: DataFrame) -> DataFrame:
    """Partner by chain by month."""
    return fct_claim.groupBy("partner", "chain", _month()).agg(
        _rows().alias("claims"),
        F.sum("net_fills").alias("fills"),
        F.sum("net_revenue").alias("revenue"),
        F.sum("net_pbm_fee").alias("fee_collected"),
        F.sum("net_partner_fee").alias("fee_paid_out"),
        F.sum("net_retained_margin").alias("margin_retained"),
        ratio(F.sum("net_partner_fee"), F.sum("net_pbm_fee")).alias("payout_ratio"),
        ratio(count_true(F.col("is_reverted")), _rows()).alias("revert_rate"),
    )


def gld_conversion_funnel(fct_lookup: DataFrame) -> DataFrame:
    """Partner by channel by month."""
    claims = count_true(F.col("converted_to_valid_claim"))
    return fct_lookup.groupBy("partner", "channel", _month()).agg(
        _rows().alias("lookups"),
        claims.alias("claims"),
        lookup_metrics()["conversion_rate"].alias("conversion_rate"),
        ratio(count_true(F.col("is_reverted")), claims).alias("revert_rate"),
        F.coalesce(lookup_metrics()["margin_per_lookup"], F.lit(0.0)).alias("margin_per_lookup"),
    )


def gld_revenue_reconciliation(
    brz_claims: DataFrame, claim_rejects: DataFrame, resolved: DataFrame, pharmacies: DataFrame, fct_claim: DataFrame
) -> DataFrame:
    """Claims and gross price by stage: landed is duplicates plus out of scope plus reverted plus net.

    Records refused at ingest have no readable price and never became bronze rows, so their value is
    NULL and they stand outside the sum. ``resolved`` is bronze after the collision policy.
    """
    money = F.coalesce(F.sum("price"), F.lit(0.0))
    foreign = resolved.join(pharmacies.select("npi"), "npi", "left_anti")
    stages: Mapping[str, tuple[DataFrame, Column]] = {
        "landed": (brz_claims, money),
        "rejected at ingest": (claim_rejects, F.lit(None).cast("double")),
        "excluded: pharmacy not in reference": (foreign, money),
        "reverted": (fct_claim.filter("is_reverted"), money),
        "net revenue": (fct_claim.filter("NOT is_reverted"), money),
    }
    counted = [
        table.agg(_rows().alias("claims"), value.alias("gross_price")).withColumn("stage", F.lit(stage))
        for stage, (table, value) in stages.items()
    ]
    counted.append(excluded_by_policy(brz_claims, resolved))
    return reduce(DataFrame.unionByName, counted).select("stage", "claims", "gross_price")


def excluded_by_policy(brz_claims: DataFrame, resolved: DataFrame) -> DataFrame:
    """What the collision policy took out, as bronze less what it left."""
    left = resolved.agg(F.struct(_rows().alias("n"), F.coalesce(F.sum("price"), F.lit(0.0)).alias("price")))
    return (
        brz_claims.agg(_rows().alias("_n"), F.coalesce(F.sum("price"), F.lit(0.0)).alias("_price"))
        .withColumn("_left", left.scalar())
        .select(
            (F.col("_n") - F.col("_left.n")).alias("claims"),
            (F.col("_price") - F.col("_left.price")).alias("gross_price"),
            F.lit("excluded: duplicate claim id").alias("stage"),
        )
    )
