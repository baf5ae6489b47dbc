"""Metrics with one definition each, as aggregate expressions and as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import count_true, ratio


def _rows() -> Column:
    return F.count(F.lit(1))


def claim_metrics() -> dict[str, Column]:
    """Aggregates for any groupBy over the claim fact."""
    return {
        "retained_margin": F.sum("net_retained_margin"),
        "retained_margin_per_fill": ratio(F.sum("net_retained_margin"), F.sum("net_fills")),
        "fee_payout_ratio": ratio(F.sum("net_partner_fee"), F.sum("net_pbm_fee")),
        "fee_collected": F.sum("net_pbm_fee"),
        "fills": F.sum("net_fills").cast("double"),
        "reversal_rate": ratio(count_true(F.col("is_reverted")), _rows()),
        "margin_lost_to_reversal": F.sum(F.when(F.col("is_reverted"), F.col("retained_margin")).otherwise(F.lit(0.0))),
        "cost_coverage": 1 - ratio(count_true(F.col("flag_cost_unavailable")), _rows()),
    }


def lookup_metrics() -> dict[str, Column]:
    """Over the lookup fact. There is no pharmacy on a lookup, so never by chain."""
    return {
        "margin_per_lookup": ratio(F.sum("net_retained_margin"), _rows()),
        "conversion_rate": ratio(count_true(F.col("converted_to_valid_claim")), _rows()),
    }


def bronze_metrics() -> dict[str, Column]:
    """Over the bronze claims."""
    return {
        "excluded_claim_value": F.sum(F.when(F.col("flag_duplicate_claim_id"), F.col("price")).otherwise(F.lit(0.0))),
    }


def measure(df: DataFrame, definitions: dict[str, Column], *by: str) -> DataFrame:
    """The named metrics in one pass, per group if any is given."""
    aggregates = [column.alias(name) for name, column in definitions.items()]
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def measure_overall_and_by(df: DataFrame, definitions: dict[str, Column], by: str, label: str = "of") -> DataFrame:
    """The named metrics over all rows ('all') and per group, from one pass; a table without rows gives none."""
    aggregates = [column.alias(name) for name, column in definitions.items()]
    rolled = df.rollup(by).agg(F.grouping(by).alias("_whole"), *aggregates)
    return rolled.select(*definitions, F.when(F.col("_whole") == 1, "all").otherwise(F.col(by)).alias(label))


def rejection_rate(brz_rejects: DataFrame, *clean: DataFrame) -> DataFrame:
    """Refused records over all records that arrived, refused ones included."""
    accepted = reduce(lambda a, b: a + b, [table.agg(_rows()).scalar() for table in clean])
    refused = brz_rejects.agg(_rows().alias("_refused"))
    return refused.select(ratio(F.col("_refused"), F.col("_refused") + accepted).alias("rejection_rate"))


def all_metrics(
    fct_claim: DataFrame, fct_lookup: DataFrame, brz_claims: DataFrame, brz_rejects: DataFrame, *clean: DataFrame
) -> DataFrame:
    """Every metric as a row (metric, value); each input is read once."""
    wide = [
        measure(fct_claim, claim_metrics()),
        measure(fct_lookup, lookup_metrics()),
        measure(brz_claims, bronze_metrics()),
        rejection_rate(brz_rejects, *clean),
    ]
    long = [table.unpivot([], table.columns, "metric", "value") for table in wide]
    return reduce(DataFrame.unionByName, long)
