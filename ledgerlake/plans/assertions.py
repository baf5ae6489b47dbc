"""Business tests over the layers. Each returns violating rows; none means it holds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.money import count_true, percent
from ledgerlake.operators import checks
from ledgerlake.operators.joins import left_join_spread
from ledgerlake.plans.gold import COST_PAIRS, FEE_PAIRS

# Tolerances.
MONEY_TOLERANCE = 0.0001
MAX_UNCOSTED_PERCENT = 10.0
MIN_SNAPSHOTS = 10
SHARE_TOLERANCE = 0.001


def _rows() -> Column:
    return F.count(F.lit(1))


def _count(df: DataFrame) -> Column:
    return df.agg(_rows()).scalar()


def bronze_drops_nothing(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Streams whose bronze and landing tables differ in size; pairs of (bronze, landing)."""
    compared = [
        bronze.agg(_rows().alias("bronze_rows")).select(
            F.lit(stream).alias("stream"), "bronze_rows", _count(landing).alias("landing_rows")
        )
        for stream, (bronze, landing) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, compared).filter("bronze_rows <> landing_rows")


def reconciliation(brz_claims: DataFrame, resolved: DataFrame, slv_claims: DataFrame, pharmacies: DataFrame) -> DataFrame:
    """The counts behind the reconciliation test.

    Holds under either policy: duplicates are the rows the policy removed, and scope is judged on the
    rows it left. ``resolved`` is bronze after the collision policy.
    """
    in_scope = left_join_spread(resolved, pharmacies.select("npi").distinct(), "npi", [], "_in_scope")
    # One pass counts what the policy left and what of it is out of scope.
    left = in_scope.agg(F.struct(_rows().alias("rows"), F.count_if(~F.col("_in_scope")).alias("foreign")))
    return (
        brz_claims.agg(_rows().alias("bronze_rows"))
        .select("bronze_rows", _count(slv_claims).alias("silver_rows"), left.scalar().alias("_left"))
        .select(
            "bronze_rows",
            "silver_rows",
            (F.col("bronze_rows") - F.col("_left.rows")).alias("duplicate_rows"),
            F.col("_left.foreign").alias("out_of_scope_rows"),
        )
    )


def bronze_reconciles_to_silver(
    brz_claims: DataFrame, resolved: DataFrame, slv_claims: DataFrame, pharmacies: DataFrame
) -> DataFrame:
    return reconciliation(brz_claims, resolved, slv_claims, pharmacies).filter(
        "bronze_rows <> silver_rows + duplicate_rows + out_of_scope_rows"
    )


def uncosted_share(fct_claim: DataFrame) -> DataFrame:
    uncosted = count_true(F.col("flag_cost_unavailable"))
    return fct_claim.agg(
        _rows().alias("claims"), uncosted.alias("uncosted"), percent(uncosted, _rows()).alias("uncosted_pct")
    )


def claims_have_costs(fct_claim: DataFrame, max_percent: float = MAX_UNCOSTED_PERCENT) -> DataFrame:
    return uncosted_share(fct_claim).filter(F.col("uncosted_pct") > max_percent)


def fee_identity(fct_claim: DataFrame, tolerance: float = MONEY_TOLERANCE) -> DataFrame:
    """What is kept and what is paid out make up the fee."""
    gap = F.abs(F.col("partner_fee") + F.col("retained_margin") - F.col("pbm_fee"))
    return fct_claim.filter(gap > tolerance).select("claim_id")


def snapshots_loaded(brz_nadac: DataFrame, at_least: int = MIN_SNAPSHOTS) -> DataFrame:
    """The price series is neither empty nor short of publication dates."""
    return brz_nadac.agg(_rows().alias("rows_loaded"), F.countDistinct("as_of_date").alias("snapshots")).filter(
        (F.col("rows_loaded") == 0) | (F.col("snapshots") < at_least)
    )


def partner_fee_within_fee(fct_claim: DataFrame, tolerance: float = MONEY_TOLERANCE) -> DataFrame:
    return fct_claim.filter(F.col("partner_fee") > F.col("pbm_fee") + tolerance).select(
        "claim_id", "pbm_fee", "partner_fee"
    )


def partner_terms_exclusive(dim_partner: DataFrame) -> DataFrame:
    """Partners that state both kinds of term, or none."""
    return dim_partner.filter(F.col("fee_cents").isNull() == F.col("fee_percentage").isNull()).select("partner")


def reverted_count_nothing(fct_claim: DataFrame) -> DataFrame:
    """Reverted claims with a net measure other than zero; a cost-based one may be unknown."""
    zeroed = ["net_fills", *FEE_PAIRS, *COST_PAIRS]
    any_left = reduce(lambda a, b: a | b, [F.col(name) != 0 for name in zeroed])
    return fct_claim.filter(F.col("is_reverted") & any_left).select("claim_id")


def reverts_follow_fills(fct_claim: DataFrame) -> DataFrame:
    return fct_claim.filter(F.col("is_reverted") & (F.col("reverted_at") < F.col("filled_at"))).select(
        "claim_id", "filled_at", "reverted_at"
    )


def claims_unique(fct_claim: DataFrame) -> DataFrame:
    return checks.unique(fct_claim, "claim_id")


def acceptance(
    fct_claim: DataFrame, fct_lookup: DataFrame, slv_claims: DataFrame, slv_claim_costs: DataFrame, slv_lookups: DataFrame
) -> DataFrame:
    """One row per acceptance rule with how far it is missed; zero is a pass."""
    early = fct_claim.filter(F.col("cost_as_of_date") > F.col("date_day")).agg(_rows().alias("misses"))
    rules = {
        "cost is known on the fill date": early,
        "cost join keeps the claim count": slv_claim_costs.agg(_rows().alias("_n")).select(
            F.abs(F.col("_n") - _count(slv_claims)).alias("misses")
        ),
        "lookup fact keeps the lookup count": fct_lookup.agg(_rows().alias("_n")).select(
            F.abs(F.col("_n") - _count(slv_lookups)).alias("misses")
        ),
    }
    return reduce(
        DataFrame.unionByName, [table.select(F.lit(rule).alias("rule"), "misses") for rule, table in rules.items()]
    )


def flat_term_in_dollars(fct_claim: DataFrame, dim_partner: DataFrame) -> DataFrame:
    """Flat-term claims whose fee covers the term but which do not pay exactly the term."""
    flat = dim_partner.filter("fee_type = 'flat'").select("partner", (F.col("fee_cents") / 100.0).alias("_term"))
    return (
        fct_claim.join(flat, "partner")
        .filter((F.col("pbm_fee") >= F.col("_term")) & (F.round("partner_fee", 4) != F.round("_term", 4)))
        .select("claim_id", "partner", "partner_fee")
    )


def percentage_term_share(
    fct_claim: DataFrame, dim_partner: DataFrame, tolerance: float = SHARE_TOLERANCE
) -> DataFrame:
    """Percentage partners whose paid part of the fee is not their percentage."""
    share = dim_partner.filter("fee_type = 'percentage'").select(
        "partner", (F.col("fee_percentage") / 100.0).alias("stated")
    )
    paid = fct_claim.groupBy("partner").agg(F.try_divide(F.sum("partner_fee"), F.sum("pbm_fee")).alias("paid"))
    return paid.join(share, "partner").filter(F.abs(F.col("paid") - F.col("stated")) > tolerance)


def zero_term_partners(fct_claim: DataFrame, dim_partner: DataFrame) -> DataFrame:
    """Zero-term partners that have no claim at all, or are paid something."""
    zero = dim_partner.filter("fee_cents = 0").select("partner")
    paid = fct_claim.groupBy("partner").agg(_rows().alias("claims"), F.sum("partner_fee").alias("paid"))
    return zero.join(paid, "partner", "left").filter("claims IS NULL OR paid <> 0")


def rejection_shifts(
    brz_rejects: DataFrame, clean: Mapping[str, DataFrame], window: int = 4, tolerance: float = 0.5
) -> DataFrame:
    """Loads whose volume or rejection rate departs from the mean of the loads before them.

    Only the counts per load meet in the window. ``tolerance`` is the allowed relative change.
    """
    counts = [
        table.groupBy("load_id").agg(_rows().alias("clean_rows")).withColumn("stream", F.lit(stream))
        for stream, table in clean.items()
    ]
    refused = brz_rejects.groupBy("stream", "load_id").agg(_rows().alias("rejects"))
    loads = (
        reduce(DataFrame.unionByName, counts)
        .join(refused, ["stream", "load_id"], "full")
        .fillna(0, ["clean_rows", "rejects"])
        .withColumn("records", F.col("clean_rows") + F.col("rejects"))
        .withColumn("rate", F.try_divide(F.col("rejects").cast("double"), F.col("records")))
    )
    # Numbered loads come in order of their numbers, others in that of their names.
    in_turn = F.col("load_id").try_cast("bigint"), F.col("load_id")
    before = Window.partitionBy("stream").orderBy(*in_turn).rowsBetween(-window, -1)
    return (
        loads.withColumn("usual_records", F.avg("records").over(before))
        .withColumn("usual_rate", F.avg("rate").over(before))
        .filter(
            (F.abs(F.col("records") - F.col("usual_records")) > F.col("usual_records") * tolerance)
            | (F.abs(F.col("rate") - F.col("usual_rate")) > F.col("usual_rate") * tolerance)
        )
        .select("stream", "load_id", "records", "rejects", "rate", "usual_records", "usual_rate")
    )


def stale_streams(streams: Mapping[str, tuple[DataFrame, str]], now: str, max_hours: int) -> DataFrame:
    """Streams whose newest event is older than allowed, or that have none; pairs of (table, time column)."""
    newest = [
        table.agg(F.max(time).alias("newest")).select(F.lit(stream).alias("stream"), "newest")
        for stream, (table, time) in streams.items()
    ]
    limit = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(max_hours))
    return reduce(DataFrame.unionByName, newest).filter(F.col("newest").isNull() | (F.col("newest") < limit))
