"""Refresh only the periods of the claim fact that a new load can have changed."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.collisions import QUARANTINE_ALL
from ledgerlake.operators.joins import semi_join_spread
from ledgerlake.operators.ranks import group_sizes
from ledgerlake.plans import gold, silver, warehouse
from ledgerlake.plans.storage import FACTS, PERIOD, Layout, arranged, buckets_of, period_of, save
from ledgerlake.session import stage

EVENTS = ("claims", "reverts", "lookups")
# Fixed value: the part of the lookback that observed delays may use up.
LOOKBACK_SHARE = 0.8


def store_fct_claim(fct_claim: DataFrame, table: str, grain: str = "day", buckets: int | None = None) -> None:
    """Store a full build of a fact, partitioned by period; a crowded period is split over several writers.

    With ``buckets`` it also lies in buckets of claim_id, and a refresh joins it without moving it.
    """
    if buckets:
        save(fct_claim, table, layout=layout_of(fct_claim, grain, buckets), mode="overwrite")
    else:
        staged = fct_claim.withColumn(PERIOD, period_of(F.col("date_day"), grain))
        staged.hint("rebalance", PERIOD).write.mode("overwrite").partitionBy(PERIOD).saveAsTable(table)


def layout_of(fact: DataFrame, grain: str, buckets: int) -> Layout:
    return replace(FACTS["fct_lookup" if "lookup_id" in fact.columns else "fct_claim"], grain=grain, buckets=buckets)


def affected_periods(
    known: Mapping[str, DataFrame], fresh: Mapping[str, DataFrame], grain: str = "day"
) -> DataFrame:
    """Periods to recompute, each once.

    These hold the new claims, and the older claims that a new revert or lookup names or that share
    their id with a new claim, however old. The search reads two columns of the older claims.
    """
    older = known["claims"].select("claim_id", F.to_date("filled_at").alias("_day"))
    named = (
        fresh["reverts"]
        .select("claim_id")
        .union(fresh["lookups"].select("claim_id"))
        .union(fresh["claims"].select("claim_id"))
        .filter("claim_id IS NOT NULL")
        .distinct()
    )
    new_days = fresh["claims"].select(F.to_date("filled_at").alias("_day"))
    days = semi_join_spread(older, named, "claim_id").select("_day").union(new_days)
    return days.select(period_of(F.col("_day"), grain).alias(PERIOD)).filter(F.col(PERIOD).isNotNull()).distinct()


def fct_claim_of_periods(
    landing: Mapping[str, DataFrame],
    periods: DataFrame,
    grain: str = "day",
    policies: warehouse.Policies = warehouse.Policies(),
) -> DataFrame:
    """The claim fact for some periods only, equal to those periods of a full build.

    Claims are limited to the periods first. Copies of their ids are counted over the id column of the
    whole landing table; lookups and reverts are limited to these ids before they are ranked.
    """
    return _PeriodWarehouse(landing, policies, periods, grain).fct_claim


class _PeriodWarehouse(warehouse.Warehouse):
    """The layers with silver claims, and so all that follows from them, limited to some periods."""

    def __init__(
        self, landing: Mapping[str, DataFrame], policies: warehouse.Policies, periods: DataFrame, grain: str
    ) -> None:
        super().__init__(landing, policies)
        self.periods, self.grain = periods, grain
        named = {name: semi_join_spread(landing[name], self.ids, "claim_id") for name in ("lookups", "reverts")}
        self.landing = dict(landing) | named

    def inside(self, claims: DataFrame) -> DataFrame:
        period = period_of(F.col("filled_date"), self.grain)
        return claims.withColumn(PERIOD, period).join(self.periods, PERIOD, "left_semi").drop(PERIOD)

    @cached_property
    def ids(self) -> DataFrame:
        """The ids of claims in the periods."""
        return self.inside(self.typed_claims).select("claim_id").distinct()

    @cached_property
    def resolved_claims(self) -> DataFrame:
        if self.policies.duplicate_claims == QUARANTINE_ALL:
            copies = semi_join_spread(self.landing["claims"].select("claim_id"), self.ids, "claim_id")
            repeated = group_sizes(copies, ["claim_id"]).filter("_n > 1")
            return semi_join_spread(self.inside(self.typed_claims), repeated, "claim_id", "left_anti")
        # The earliest copy of an id may lie in another period.
        copies = semi_join_spread(self.typed_claims, self.ids, "claim_id")
        return self.inside(silver.resolved_claims(copies, self.policies.duplicate_claims))


def replace_periods(spark: SparkSession, table: str, rows: DataFrame, periods: DataFrame, grain: str) -> None:
    """Put ``rows`` in place of the given periods of the stored fact.

    The rows are computed once, into the scratch folder, and put in place from there, partition by
    partition. A period that lost its last row would keep its old ones, so its partition is dropped;
    only such periods, a handful of dates, reach the driver and go in one statement. A rerun after a failure gives the same
    table.
    """
    staged = stage(rows.withColumn(PERIOD, period_of(F.col("date_day"), grain)), "fct-claim")
    columns, buckets = spark.table(table).columns, buckets_of(spark, table)
    if buckets:
        placed = arranged(staged.drop(PERIOD), layout_of(staged, grain, buckets))
    else:
        placed = staged.hint("rebalance", PERIOD)
    with _dynamic_overwrite(spark):
        placed.select(*columns).write.insertInto(table, overwrite=True)
    emptied = periods.join(staged.select(PERIOD).distinct(), PERIOD, "left_anti")
    if gone := ", ".join(f"PARTITION ({PERIOD} = DATE'{start}')" for (start,) in emptied.collect()):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {gone}")


def refresh_fct_claim(
    spark: SparkSession,
    table: str,
    known: Mapping[str, DataFrame],
    fresh: Mapping[str, DataFrame],
    grain: str = "day",
    policies: warehouse.Policies = warehouse.Policies(),
    lookup_table: str | None = None,
) -> None:
    """Bring a stored claim fact up to date with a new load; reference tables come from ``known``.

    With ``lookup_table`` the stored lookup fact follows, by its own periods.
    """
    merged = dict(known) | {name: known[name].unionByName(fresh[name]) for name in EVENTS}
    periods = stage(affected_periods(known, fresh, grain), "periods")
    replace_periods(spark, table, fct_claim_of_periods(merged, periods, grain, policies), periods, grain)
    if lookup_table is not None:
        days = affected_lookup_periods(merged, fresh, periods, grain)
        lookup_periods = stage(days, "lookup-periods")
        stored = spark.table(table).drop(PERIOD)
        rows = fct_lookup_of_periods(merged, lookup_periods, stored, grain, policies, bool(buckets_of(spark, table)))
        replace_periods(spark, lookup_table, rows, lookup_periods, grain)


def affected_lookup_periods(
    merged: Mapping[str, DataFrame], fresh: Mapping[str, DataFrame], claim_periods: DataFrame, grain: str = "day"
) -> DataFrame:
    """Periods of lookups that are new, or name a claim of the given claim periods."""
    day = period_of(F.to_date("looked_up_at"), grain).alias(PERIOD)
    filled = merged["claims"].select("claim_id", period_of(F.to_date("filled_at"), grain).alias(PERIOD))
    ids = filled.join(claim_periods, PERIOD, "left_semi").select("claim_id").distinct()
    named = semi_join_spread(merged["lookups"].select("claim_id", "looked_up_at"), ids, "claim_id")
    return named.select(day).union(fresh["lookups"].select(day)).filter(F.col(PERIOD).isNotNull()).distinct()


def fct_lookup_of_periods(
    landing: Mapping[str, DataFrame],
    periods: DataFrame,
    fct_claim: DataFrame,
    grain: str = "day",
    policies: warehouse.Policies = warehouse.Policies(),
    bucketed: bool = False,
) -> DataFrame:
    """The lookup fact for some periods, equal to those of a full build, from a claim fact that is up to date.

    ``bucketed`` says that the claim fact is stored in buckets of claim_id; it is not moved then.
    """
    period = period_of(F.to_date("looked_up_at"), grain)
    lookups = landing["lookups"].withColumn(PERIOD, period).join(periods, PERIOD, "left_semi").drop(PERIOD)
    w = warehouse.Warehouse(dict(landing) | {"lookups": lookups}, policies)
    if bucketed:
        return gold.fct_lookup_by_bucket(w.slv_lookups, fct_claim)
    claims = semi_join_spread(fct_claim, lookups.select("claim_id").filter("claim_id IS NOT NULL").distinct(), "claim_id")
    return gold.fct_lookup(w.slv_lookups, claims)


def lookback_suffices(fct_claim: DataFrame, lookback_hours: float, share: float = LOOKBACK_SHARE) -> DataFrame:
    """The longest observed delay of a revert, if it uses up too much of the lookback; else no row."""
    return fct_claim.agg(F.max("hours_to_revert").alias("longest_hours")).filter(
        F.col("longest_hours") > lookback_hours * share
    )


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)
