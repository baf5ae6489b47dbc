"""Gold: two facts and four conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import calendar_parts, minutes_between
from ledgerlake.functions.money import net_measures
from ledgerlake.operators.joins import HOT_ROWS, hot_keys, left_join_spread
from ledgerlake.operators.ranks import group_sizes, top_one

FEE_PAIRS = {
    "net_revenue": "price",
    "net_quantity": "quantity",
    "net_pbm_fee": "pbm_fee",
    "net_partner_fee": "partner_fee",
    "net_retained_margin": "retained_margin",
}
COST_PAIRS = {"net_pharmacy_margin": "pharmacy_margin", "net_drug_cost": "drug_cost"}


def dim_date(claims: DataFrame, lookups: DataFrame) -> DataFrame:
    """Every day from the first to the last event of either kind."""
    seen = lookups.agg(F.struct(F.min("looked_up_date").alias("first"), F.max("looked_up_date").alias("last")))
    bounds = claims.agg(F.min("filled_date").alias("first"), F.max("filled_date").alias("last")).withColumn(
        "_other", seen.scalar()
    )
    days = bounds.select(
        F.explode(
            F.sequence(
                F.least("first", "_other.first"), F.greatest("last", "_other.last"), F.expr("INTERVAL 1 DAY")
            )
        ).alias("date_day")
    )
    return days.select("date_day", *[part.alias(name) for name, part in calendar_parts(F.col("date_day")).items()])


def observed_codes(claims: DataFrame, lookups: DataFrame) -> DataFrame:
    """The drug codes of either kind of event, each once."""
    return claims.select("ndc").union(lookups.select("ndc")).distinct()


def dim_drug(claims: DataFrame, lookups: DataFrame, prices: DataFrame) -> DataFrame:
    """Every observed code, described by its newest price row where there is one."""
    attributes = ["ndc_description", "pricing_unit", "rate_setting_class", "is_generic", "is_otc"]
    newest = top_one(prices.select("ndc", "as_of_date", *attributes), ["ndc"], [F.col("as_of_date").desc()])
    described = newest.withColumn("_described", F.lit(True)).drop("as_of_date")
    return (
        observed_codes(claims, lookups)
        .join(described, "ndc", "left")
        .select("ndc", *attributes, F.col("_described").isNull().alias("is_missing_from_nadac"))
    )


def dim_partner(partners: DataFrame) -> DataFrame:
    return partners.select("partner", "fee_cents", "fee_percentage", "fee_type")


def dim_pharmacy(pharmacies: DataFrame) -> DataFrame:
    return pharmacies.select("npi", "chain")


FEE_FACT = [
    "claim_id",
    "npi",
    "ndc",
    "partner",
    "filled_date",
    "chain",
    "channel",
    "fee_type",
    "filled_at",
    "is_reverted",
    "reverted_at",
    "looked_up_at",
    "price",
    "quantity",
    "unit_price",
    "pbm_fee",
    "partner_fee",
    "retained_margin",
    "flag_fee_exceeds_price",
]
FCT_CLAIM = [
    "claim_id",
    "npi",
    "ndc",
    "partner",
    "date_day",
    "chain",
    "channel",
    "fee_type",
    "filled_at",
    "is_reverted",
    "reverted_at",
    "hours_to_revert",
    "looked_up_at",
    "minutes_lookup_to_fill",
    "price",
    "quantity",
    "unit_price",
    "pbm_fee",
    "partner_fee",
    "retained_margin",
    "pharmacy_margin",
    "drug_cost",
    "nadac_per_unit",
    *FEE_PAIRS,
    *COST_PAIRS,
    "net_fills",
    "is_generic",
    "cost_as_of_date",
    "flag_cost_unavailable",
    "flag_fee_exceeds_price",
]


def fee_fact(claim_fees: DataFrame) -> DataFrame:
    """The claim fact without its cost columns, for what needs none and should not wait for the cost join."""
    return _with_fee_nets(claim_fees.select(*FEE_FACT))


def fct_claim(economics: DataFrame) -> DataFrame:
    """One row per valid claim, reverted ones included; totals are taken over the net columns."""
    return (
        _with_fee_nets(economics)
        .select(
            "*",
            minutes_between(F.col("looked_up_at"), F.col("filled_at")).alias("minutes_lookup_to_fill"),
            *net_measures(F.col("is_reverted"), COST_PAIRS),
        )
        .select(*FCT_CLAIM)
    )


def _with_fee_nets(claims: DataFrame) -> DataFrame:
    return claims.withColumnRenamed("filled_date", "date_day").select(
        "*",
        *net_measures(F.col("is_reverted"), FEE_PAIRS),
        (~F.col("is_reverted")).cast("int").alias("net_fills"),
    )


CLAIM_CONTEXT = ["chain", "is_reverted", "net_revenue", "net_pbm_fee", "net_retained_margin", "filled_at"]


def fct_lookup(lookups: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per lookup with what became of it; most lookups name no claim.

    ``claims`` is the claim fact or the ``fee_fact``; no cost is shown here.
    """
    return _outcomes(left_join_spread(lookups, claims, "claim_id", CLAIM_CONTEXT))


def fct_lookup_by_bucket(lookups: DataFrame, claims: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """fct_lookup() for a claim fact that is stored in buckets of claim_id: its rows are not moved.

    Lookups without a claim take no part in the join. Those of the few hot claims, which one bucket's task would
    have to bear, take their claims by a broadcast of at most HOT_KEYS rows. All others go to the buckets.
    """
    named = lookups.filter("claim_id IS NOT NULL")
    sizes = group_sizes(named.select("claim_id"), ["claim_id"])
    hot = F.broadcast(hot_keys(sizes, sizes.agg(F.sum("_n")).scalar(), hot_rows).select(F.col("claim_id").alias("_hot")))
    context = claims.select("claim_id", *CLAIM_CONTEXT, F.lit(True).alias("_matched"))
    rest = named.join(hot, F.col("claim_id") == F.col("_hot"), "left_anti").join(context, "claim_id", "left")
    few = F.broadcast(context.join(hot, F.col("claim_id") == F.col("_hot"), "left_semi"))
    heavy = named.join(hot, F.col("claim_id") == F.col("_hot"), "left_semi").join(few, "claim_id", "left")
    none = lookups.filter("claim_id IS NULL")
    joined = rest.unionByName(heavy).unionByName(none, allowMissingColumns=True)
    return _outcomes(joined.withColumn("_matched", F.col("_matched").isNotNull()))


def _outcomes(joined: DataFrame) -> DataFrame:
    return joined.select(
        "lookup_id",
        "claim_id",
        "ndc",
        "partner",
        "channel",
        F.col("looked_up_date").alias("date_day"),
        "looked_up_at",
        F.col("flag_converted").alias("converted"),
        F.col("_matched").alias("converted_to_valid_claim"),
        "flag_unknown_partner",
        "chain",
        "is_reverted",
        "net_revenue",
        "net_pbm_fee",
        "net_retained_margin",
        minutes_between(F.col("looked_up_at"), F.col("filled_at")).alias("minutes_to_fill"),
    )
