"""Bronze: type, rename, stamp and flag. No row is dropped here."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.parsing import blank_to_null
from ledgerlake.operators.collisions import flag_collisions
from ledgerlake.operators.ranks import number_rows

# Fixed value: the channel of a lookup that names none.
UNKNOWN_CHANNEL = "unknown"
# Fixed value: the rate class of a generic drug.
GENERIC_CLASS = "G"


def typed_claims(claims: DataFrame) -> DataFrame:
    """Bronze claims before the flags that look at other rows."""
    return claims.select(
        "claim_id",
        "npi",
        "ndc",
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("pbm_fee").cast("double").alias("pbm_fee"),
        F.col("filled_at").cast("timestamp_ntz").alias("filled_at"),
        F.col("filled_at").cast("date").alias("filled_date"),
        (F.col("pbm_fee") > F.col("price")).alias("flag_fee_exceeds_price"),
        "source_file",
        "load_id",
    )


def brz_claims(typed: DataFrame) -> DataFrame:
    return flag_collisions(typed, "claim_id", "flag_duplicate_claim_id", "claim_id_occurrences")


def brz_lookups(lookups: DataFrame) -> DataFrame:
    named = blank_to_null(F.col("channel"))
    return lookups.select(
        "lookup_id",
        "claim_id",
        "ndc",
        "partner",
        F.col("channel").alias("channel_raw"),
        F.coalesce(F.lower(named), F.lit(UNKNOWN_CHANNEL)).alias("channel"),
        F.col("claim_id").isNotNull().alias("flag_converted"),
        named.isNull().alias("flag_missing_channel"),
        F.col("looked_up_at").cast("timestamp_ntz").alias("looked_up_at"),
        F.col("looked_up_at").cast("date").alias("looked_up_date"),
        "source_file",
        "load_id",
    )


def brz_reverts(reverts: DataFrame) -> DataFrame:
    typed = reverts.select(
        "revert_id",
        "claim_id",
        F.col("reverted_at").cast("timestamp_ntz").alias("reverted_at"),
        F.col("reverted_at").cast("date").alias("reverted_date"),
        "source_file",
        "load_id",
    )
    numbered = number_rows(typed, "claim_id", "reverted_at", ["revert_id"], "revert_sequence", "_reverts")
    return numbered.withColumn("flag_multiple_reverts", F.col("_reverts") > 1).drop("_reverts")


def brz_nadac(nadac: DataFrame) -> DataFrame:
    return nadac.filter("as_of_date IS NOT NULL").select(
        "ndc",
        "ndc_description",
        F.col("nadac_per_unit").cast("double").alias("nadac_per_unit"),
        F.col("effective_date").cast("date").alias("effective_date"),
        F.col("as_of_date").cast("date").alias("as_of_date"),
        "pricing_unit",
        "rate_setting_class",
        (F.col("rate_setting_class") == GENERIC_CLASS).alias("is_generic"),
        "is_otc",
        "load_id",
    )


def brz_partners(partners: DataFrame) -> DataFrame:
    flat, share = F.col("fee_cents").isNotNull(), F.col("fee_percentage").isNotNull()
    return partners.select(
        "partner",
        F.col("fee_cents").cast("double").alias("fee_cents"),
        F.col("fee_percentage").cast("double").alias("fee_percentage"),
        (flat & share).alias("flag_both_fee_terms"),
        (~flat & ~share).alias("flag_no_fee_terms"),
        "load_id",
    )


def brz_pharmacies(pharmacies: DataFrame) -> DataFrame:
    return pharmacies.select("npi", F.lower(F.trim("chain")).alias("chain"), "load_id")


def brz_rejects(rejects: Mapping[str, DataFrame]) -> DataFrame:
    """The reject tables of all streams under each other, named by stream."""
    parts = [
        table.select(F.lit(stream).alias("stream"), "reject_reason", "raw_payload", "source_file", "load_id")
        for stream, table in rejects.items()
    ]
    return reduce(DataFrame.unionByName, parts)
