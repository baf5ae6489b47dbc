"""Silver: resolve identity and scope, conform, price. Rows leave here and only here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import hours_between
from ledgerlake.functions.money import fee_type, partner_fee_share
from ledgerlake.operators.asof import asof_join, join_validity
from ledgerlake.operators.collisions import resolve_collisions
from ledgerlake.operators.joins import left_join_spread
from ledgerlake.operators.ranks import top_one

# The cost bases.
AS_OF_FILL = "as_of_fill"
LATEST = "latest"
COST_BASES = (AS_OF_FILL, LATEST)

# Prices come weekly at the shortest; a quarter keeps both copies and comparisons few.
PRICE_PERIOD = "quarter"
COST_COLUMNS = ["nadac_per_unit", "as_of_date", "pricing_unit", "is_generic"]


def slv_pharmacies(brz_pharmacies: DataFrame) -> DataFrame:
    """The pharmacies in scope."""
    return brz_pharmacies.select("npi", "chain")


def slv_partners(brz_partners: DataFrame) -> DataFrame:
    """Partners with at most one kind of term; those that state both are left out."""
    return brz_partners.filter("NOT flag_both_fee_terms").select(
        "partner",
        "fee_cents",
        "fee_percentage",
        fee_type(F.col("fee_cents"), F.col("fee_percentage")).alias("fee_type"),
    )


def slv_nadac(brz_nadac: DataFrame) -> DataFrame:
    """One price per code and publication date; the newest effective date wins."""
    newest = [F.col("effective_date").desc_nulls_last(), F.col("nadac_per_unit").desc_nulls_last()]
    newest += [F.col(c) for c in sorted(brz_nadac.columns)]  # so that ties leave nothing to chance
    return top_one(brz_nadac, ["ndc", "as_of_date"], newest).drop("load_id")


def resolved_claims(claims: DataFrame, policy: str) -> DataFrame:
    """One row per claim id under the collision policy. The order is total, so the choice is stable."""
    first = ["filled_at", "source_file", "ndc", "npi"]
    first += sorted(set(claims.columns) - set(first))
    return resolve_collisions(claims, "claim_id", policy, [F.col(c) for c in first])


def slv_claims(resolved: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """Resolved claims of pharmacies in scope, with the chain."""
    return resolved.join(pharmacies, "npi").select(
        "claim_id",
        "npi",
        "chain",
        "ndc",
        "price",
        "quantity",
        "pbm_fee",
        "filled_at",
        "filled_date",
        "flag_fee_exceeds_price",
        "source_file",
    )


def slv_lookups(brz_lookups: DataFrame, partners: DataFrame) -> DataFrame:
    """All lookups; an unlisted partner is flagged."""
    return left_join_spread(brz_lookups, partners.select("partner"), "partner", [], "_known").select(
        "lookup_id",
        "claim_id",
        "ndc",
        "partner",
        "channel",
        "channel_raw",
        "looked_up_at",
        "looked_up_date",
        "flag_converted",
        (~F.col("_known")).alias("flag_unknown_partner"),
    )


def slv_reverts(brz_reverts: DataFrame, claims: DataFrame) -> DataFrame:
    """The first revert of each claim that survives in silver."""
    return (
        brz_reverts.filter("revert_sequence = 1")
        .join(claims.select("claim_id"), "claim_id", "left_semi")
        .select("revert_id", "claim_id", "reverted_at", "reverted_date", "flag_multiple_reverts")
    )


def first_reverts(reverts: DataFrame) -> DataFrame:
    """The first revert per claim id, without numbering the others."""
    return top_one(
        reverts.select("claim_id", "revert_id", "reverted_at"), ["claim_id"], [F.col("reverted_at"), F.col("revert_id")]
    )


def attach_costs(
    claims: DataFrame, prices: DataFrame, basis: str = AS_OF_FILL, span: DataFrame | None = None
) -> DataFrame:
    """Attach a unit cost to every claim: that known on the fill date, or the newest one.

    The newest prices, one row per code, are never broadcast: measured by their compressed shuffle, a million of them
    look small, and would go through the driver at many times that size.
    """
    if basis == AS_OF_FILL:
        costed = asof_join(claims, prices, "ndc", "filled_date", "as_of_date", COST_COLUMNS, PRICE_PERIOD, span)
    elif basis == LATEST:
        newest = top_one(prices.select("ndc", *COST_COLUMNS), ["ndc"], [F.col("as_of_date").desc()])
        costed = left_join_spread(claims, newest.hint("merge"), "ndc", COST_COLUMNS).drop("_matched")
    else:
        raise ValueError(f"cost basis must be one of {COST_BASES}, not {basis!r}")
    return costed.withColumnRenamed("as_of_date", "cost_as_of_date").withColumn(
        "flag_cost_unavailable", F.col("nadac_per_unit").isNull()
    )


def converting_lookups(lookups: DataFrame) -> DataFrame:
    """The first converting lookup of each claim: it earns the attribution. Ties go to the lower id."""
    converted = lookups.filter("claim_id IS NOT NULL").select(
        "claim_id", "partner", "channel", "looked_up_at", "lookup_id"
    )
    return top_one(converted, ["claim_id"], [F.col("looked_up_at"), F.col("lookup_id")]).drop("lookup_id")


def attribute(claims: DataFrame, lookups: DataFrame, partners: DataFrame, reverts: DataFrame) -> DataFrame:
    """Claims with their partner, its terms and their revert, as far as there are any.

    All large inputs meet on claim_id, so each is shuffled once. ``reverts`` holds one row per claim;
    reverts of other claims find no partner row and need not be filtered out beforehand.
    """
    terms = ["fee_cents", "fee_percentage", "fee_type"]
    attributed = _with_reverts(claims.join(converting_lookups(lookups), "claim_id", "left"), reverts)
    return left_join_spread(attributed, partners, "partner", terms).drop("_matched")


def attribute_dated(claims: DataFrame, lookups: DataFrame, history: DataFrame, reverts: DataFrame) -> DataFrame:
    """As ``attribute`` with the terms in force on the fill date, from a versioned partner table."""
    attributed = claims.join(converting_lookups(lookups), "claim_id", "left")
    dated = history.withColumn("fee_type", fee_type(F.col("fee_cents"), F.col("fee_percentage")))
    terms = ["fee_cents", "fee_percentage", "fee_type"]
    return _with_reverts(
        join_validity(attributed, dated, "partner", "filled_date", "valid_from", "valid_to", terms), reverts
    )


def _with_reverts(claims: DataFrame, reverts: DataFrame) -> DataFrame:
    return claims.join(reverts.select("claim_id", "revert_id", "reverted_at"), "claim_id", "left")


def split_fees(attributed: DataFrame) -> DataFrame:
    """Reversal, unit price and fee split of attributed claims; needs no cost."""
    fee = partner_fee_share(F.col("pbm_fee"), F.col("fee_cents"), F.col("fee_percentage"))
    return (
        attributed.withColumn("is_reverted", F.col("revert_id").isNotNull())
        .withColumn("unit_price", F.try_divide("price", F.nullif("quantity", F.lit(0.0))))
        .withColumn("partner_fee", fee)
        .withColumn("retained_margin", F.col("pbm_fee") - F.col("partner_fee"))
    )


def price_out(costed: DataFrame) -> DataFrame:
    """The cost of the quantity sold, unknown without a unit cost."""
    return costed.withColumn("drug_cost", F.col("nadac_per_unit") * F.col("quantity"))


def slv_claim_economics(priced: DataFrame) -> DataFrame:
    """What each party keeps of a claim; the pharmacy's margin is unknown without a cost."""
    return priced.select(
        "claim_id",
        "npi",
        "chain",
        "ndc",
        "partner",
        "channel",
        "fee_type",
        "filled_at",
        "filled_date",
        "looked_up_at",
        "is_reverted",
        "reverted_at",
        hours_between(F.col("filled_at"), F.col("reverted_at")).alias("hours_to_revert"),
        "price",
        "quantity",
        "unit_price",
        "pbm_fee",
        "drug_cost",
        "nadac_per_unit",
        "cost_as_of_date",
        "partner_fee",
        "retained_margin",
        (F.col("price") - F.col("drug_cost") - F.col("pbm_fee")).alias("pharmacy_margin"),
        "is_generic",
        "flag_cost_unavailable",
        "flag_fee_exceeds_price",
    )
