"""All layers from the landed tables, and how they are stored."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.collisions import POLICIES, QUARANTINE_ALL
from ledgerlake.plans import bronze, gold, marts, silver, storage, suite
from ledgerlake.plans.publication import Draft, retire
from ledgerlake.sources.landing import EVENT_SOURCES

LAYERS = {
    "bronze": (
        "brz_claims",
        "brz_lookups",
        "brz_reverts",
        "brz_nadac",
        "brz_partners",
        "brz_pharmacies",
        "brz_rejects",
    ),
    "silver": (
        "slv_pharmacies",
        "slv_partners",
        "slv_nadac",
        "slv_claims",
        "slv_lookups",
        "slv_reverts",
        "slv_claim_costs",
        "slv_claim_economics",
    ),
    "gold": (
        "dim_date",
        "dim_drug",
        "dim_partner",
        "dim_pharmacy",
        "fct_claim",
        "fct_lookup",
        "gld_partner_performance",
        "gld_conversion_funnel",
        "gld_revenue_reconciliation",
    ),
}
# Whose terms apply to a claim, those that hold now or those of the fill date.
CURRENT_TERMS = "current"
DATED_TERMS = "dated"


@dataclass(frozen=True)
class Policies:
    """The modelling decisions that are open to choice."""

    duplicate_claims: str = QUARANTINE_ALL
    cost_basis: str = silver.AS_OF_FILL
    partner_terms: str = CURRENT_TERMS

    def __post_init__(self) -> None:
        if self.duplicate_claims not in POLICIES:
            raise ValueError(f"collision policy must be one of {POLICIES}, not {self.duplicate_claims!r}")
        if self.cost_basis not in silver.COST_BASES:
            raise ValueError(f"cost basis must be one of {silver.COST_BASES}, not {self.cost_basis!r}")
        if self.partner_terms not in (CURRENT_TERMS, DATED_TERMS):
            raise ValueError(f"partner terms must be {CURRENT_TERMS!r} or {DATED_TERMS!r}, not {self.partner_terms!r}")


class Warehouse:
    """Every table of every layer as a lazy frame over the landed tables, made when first asked for."""

    def __init__(self, landing: Mapping[str, DataFrame], policies: Policies = Policies()) -> None:
        self.landing = landing
        self.policies = policies
        # Whether the claim fact is stored in buckets of claim_id.
        self.bucketed = False

    def tables(self, *layers: str) -> dict[str, DataFrame]:
        """The tables of the given layers, of all by default, by name."""
        names = [name for layer in layers or LAYERS for name in LAYERS[layer]]
        return {name: getattr(self, name) for name in names if self.has(name)}

    def has(self, name: str) -> bool:
        """Whether the landed tables allow for a table; only rejects, and what is counted from them, may be absent."""
        if name == "gld_revenue_reconciliation":
            return "claims" in self._rejects
        return name != "brz_rejects" or bool(self._rejects)

    def replace(self, name: str, stored: DataFrame, bucketed: bool = False) -> None:
        """Let all tables not made yet build on a stored table; facts also serve the dimensions.

        ``bucketed`` says that the stored table lies in buckets of claim_id, see plans.storage.
        """
        setattr(self, name, stored)
        if name == "fct_claim":
            self.fee_fact = stored
            self.bucketed = bucketed
            self.claim_days = stored.select("ndc", F.col("date_day").alias("filled_date"))
        elif name == "fct_lookup":
            self.lookup_days = stored.select("ndc", F.col("date_day").alias("looked_up_date"))

    @cached_property
    def claim_days(self) -> DataFrame:
        """Code and date of each silver claim, which is all the dimensions need."""
        return self.slv_claims.select("ndc", "filled_date")

    @cached_property
    def lookup_days(self) -> DataFrame:
        return self.slv_lookups.select("ndc", "looked_up_date")

    @property
    def _rejects(self) -> dict[str, DataFrame]:
        found = {stream: self.landing.get(f"{stream}_rejects") for stream in EVENT_SOURCES}
        return {stream: table for stream, table in found.items() if table is not None}

    @cached_property
    def typed_claims(self) -> DataFrame:
        return bronze.typed_claims(self.landing["claims"])

    @cached_property
    def brz_claims(self) -> DataFrame:
        return bronze.brz_claims(self.typed_claims)

    @cached_property
    def brz_lookups(self) -> DataFrame:
        return bronze.brz_lookups(self.landing["lookups"])

    @cached_property
    def brz_reverts(self) -> DataFrame:
        return bronze.brz_reverts(self.landing["reverts"])

    @cached_property
    def brz_nadac(self) -> DataFrame:
        return bronze.brz_nadac(self.landing["nadac"])

    @cached_property
    def brz_partners(self) -> DataFrame:
        return bronze.brz_partners(self.landing["partners"])

    @cached_property
    def brz_pharmacies(self) -> DataFrame:
        return bronze.brz_pharmacies(self.landing["pharmacies"])

    @cached_property
    def brz_rejects(self) -> DataFrame:
        return bronze.brz_rejects(self._rejects)

    @cached_property
    def slv_pharmacies(self) -> DataFrame:
        return silver.slv_pharmacies(self.brz_pharmacies)

    @cached_property
    def slv_partners(self) -> DataFrame:
        return silver.slv_partners(self.brz_partners)

    @cached_property
    def slv_nadac(self) -> DataFrame:
        return silver.slv_nadac(self.brz_nadac)

    @cached_property
    def resolved_claims(self) -> DataFrame:
        """Bronze claims after the collision policy and before the scope filter.

        They come without the bronze flags on copies: the policy does its own counting, in a form that
        leaves the rows by claim_id.
        """
        return silver.resolved_claims(self.typed_claims, self.policies.duplicate_claims)

    @cached_property
    def slv_claims(self) -> DataFrame:
        return silver.slv_claims(self.resolved_claims, self.slv_pharmacies)

    @cached_property
    def slv_lookups(self) -> DataFrame:
        return silver.slv_lookups(self.brz_lookups, self.slv_partners)

    @cached_property
    def slv_reverts(self) -> DataFrame:
        return silver.slv_reverts(self.brz_reverts, self.slv_claims)

    @cached_property
    def _fill_dates(self) -> DataFrame:
        """The landed fill dates: they bound the silver ones and cost a scan of one column."""
        return self.landing["claims"].select(F.to_date("filled_at").alias("filled_date"))

    @cached_property
    def slv_claim_costs(self) -> DataFrame:
        return silver.attach_costs(self.slv_claims, self.slv_nadac, self.policies.cost_basis, self._fill_dates)

    @cached_property
    def claim_fees(self) -> DataFrame:
        """Claims with partner, reversal and fee split, before any cost.

        All large inputs meet on claim_id here. The cost join needs another key; put after, it costs
        one shuffle of the claims instead of two, and what needs no cost does not pay for it.
        """
        # Whether a partner is known matters to the lookup fact only, hence the bronze lookups.
        reverts = silver.first_reverts(self.landing["reverts"])
        if self.policies.partner_terms == DATED_TERMS:
            # A version of a partner's terms per row, with valid_from and valid_to; see operators.scd2.
            history = self.landing["partner_history"]
            return silver.split_fees(silver.attribute_dated(self.slv_claims, self.brz_lookups, history, reverts))
        return silver.split_fees(silver.attribute(self.slv_claims, self.brz_lookups, self.slv_partners, reverts))

    @cached_property
    def slv_claim_economics(self) -> DataFrame:
        costed = silver.attach_costs(self.claim_fees, self.slv_nadac, self.policies.cost_basis, self._fill_dates)
        return silver.slv_claim_economics(silver.price_out(costed))

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.claim_days, self.lookup_days)

    @cached_property
    def dim_drug(self) -> DataFrame:
        return gold.dim_drug(self.claim_days, self.lookup_days, self.slv_nadac)

    @cached_property
    def dim_partner(self) -> DataFrame:
        return gold.dim_partner(self.slv_partners)

    @cached_property
    def dim_pharmacy(self) -> DataFrame:
        return gold.dim_pharmacy(self.slv_pharmacies)

    @cached_property
    def fee_fact(self) -> DataFrame:
        """The claim fact without its cost columns."""
        return gold.fee_fact(self.claim_fees)

    @cached_property
    def fct_claim(self) -> DataFrame:
        return gold.fct_claim(self.slv_claim_economics)

    @cached_property
    def fct_lookup(self) -> DataFrame:
        build = gold.fct_lookup_by_bucket if self.bucketed else gold.fct_lookup
        return build(self.slv_lookups, self.fee_fact)

    @cached_property
    def gld_partner_performance(self) -> DataFrame:
        return marts.gld_partner_performance(self.fee_fact)

    @cached_property
    def gld_conversion_funnel(self) -> DataFrame:
        return marts.gld_conversion_funnel(self.fct_lookup)

    @cached_property
    def gld_revenue_reconciliation(self) -> DataFrame:
        return marts.gld_revenue_reconciliation(
            self.brz_claims, self._rejects["claims"], self.resolved_claims, self.slv_pharmacies, self.fee_fact
        )


def register(tables: Mapping[str, DataFrame]) -> None:
    """Offer tables to SQL as views of the same names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def materialize(
    spark: SparkSession,
    warehouse: Warehouse,
    folder: str,
    store: tuple[str, ...] = ("gold",),
    prefix: str = "",
    test: bool = False,
    layouts: Mapping[str, storage.Layout] = storage.FACTS,
    keep: int | None = None,
) -> dict[str, DataFrame]:
    """Full refresh. Tables of the layers in ``store`` are written, all others stay views.

    The stored tables make a release, see plans.publication: they are written beside those in use, tested if
    ``test`` is set, and published together; a refresh that fails before, or breaks a declared test, leaves the
    old release in use. Facts are stored by period and in buckets, as ``layouts`` says, and have the column
    ``period_start`` besides their own. With ``keep`` older releases are removed afterwards but for so many.

    Every table can be queried by its name, a stored one also as ``layer.name`` (the layer's database may get a
    prefix). What is stored is read back by whatever builds on it: with gold stored, the claims are priced once, the
    dimensions come from two columns of the facts, and the lookup fact meets the stored claims bucket by bucket. A
    fact that is kept up to date by parts is stored by ``plans.incremental``.
    """
    tables: dict[str, DataFrame] = {}
    draft = Draft(spark, folder, prefix)
    for layer, names in LAYERS.items():
        # Facts first: the dimensions are read off them.
        for name in sorted(names, key=lambda n: not n.startswith("fct_")):
            if not warehouse.has(name):
                continue
            frame = getattr(warehouse, name)
            if layer in store:
                layout = layouts.get(name)
                frame = draft.write(layer, name, frame, layout)
                warehouse.replace(name, frame, bucketed=bool(layout) and layout.key == "claim_id")
            tables[name] = frame
    if test and (broken := suite.failures(suite.run_tests(warehouse))):
        raise ValueError(f"violations by test: {broken}")
    if draft.release.tables:
        draft.publish()
    register(tables)
    if keep is not None:
        retire(spark, folder, keep)
    return tables
