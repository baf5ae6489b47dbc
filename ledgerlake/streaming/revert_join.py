"""Claims with their revert, as both arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import as_instant


def claims_with_reverts(claims: DataFrame, reverts: DataFrame, lookback: str, delay: str) -> DataFrame:
    """Left join of two streams: a revert counts if it comes within ``lookback`` of the fill.

    Both sides may be late by ``delay``. State is bounded by the lookback: a claim without a revert is
    emitted once the watermark has passed the end of its lookback. A claim is emitted once: of several
    reverts inside its lookback the first to arrive counts (of those that arrive together, any);
    claims_with_earliest_revert() settles which is the earliest. Reverts outside the lookback count for nothing.
    """
    joined = _inside_lookback(claims, reverts, lookback, delay)
    return (
        joined.withColumn("is_reverted", F.col("revert_id").isNotNull())
        .drop("_claim_id", "_reverted")
        # A claim is remembered until the join can add nothing to it, that is for its whole lookback.
        .dropDuplicates(["claim_id", "_filled"])
        .drop("_filled")
    )


def claims_with_earliest_revert(claims: DataFrame, reverts: DataFrame, lookback: str, delay: str) -> DataFrame:
    """The same join, with the earliest revert of each claim in whatever order they arrive, ties by revert_id.

    A claim, reverted or not, is emitted once, when the watermark has passed the end of its lookback and no revert can
    be added to it; what it says then is final, where claims_with_reverts() says sooner whether there is a revert.
    State is bounded by the lookback: behind the join a claim keeps its earliest revert only. Repeated rows of a claim
    come out once. A claim needs a ``filled_at``, else it never comes out.
    """
    earliest = F.min(F.when(F.col("_claim_id").isNotNull(), F.struct("reverted_at", "revert_id")))
    return (
        _inside_lookback(claims, reverts, lookback, delay)
        # The watermark behind the join waits for the lookback, so a group closes when it is over.
        .groupBy("_filled", *claims.columns)
        .agg(earliest.alias("_first"))
        .select(*claims.columns, "_first.revert_id", "_first.reverted_at", F.col("_first").isNotNull().alias("is_reverted"))
    )


def _inside_lookback(claims: DataFrame, reverts: DataFrame, lookback: str, delay: str) -> DataFrame:
    """Every claim beside each of its reverts inside the lookback, or beside none."""
    fills = claims.withColumn("_filled", as_instant(F.col("filled_at"))).withWatermark("_filled", delay)
    voids = reverts.select(
        F.col("claim_id").alias("_claim_id"),
        "revert_id",
        "reverted_at",
        as_instant(F.col("reverted_at")).alias("_reverted"),
    ).withWatermark("_reverted", delay)
    in_time = F.expr(f"claim_id = _claim_id AND _reverted >= _filled AND _reverted <= _filled + INTERVAL {lookback}")
    return fills.join(voids, in_time, "leftOuter")
