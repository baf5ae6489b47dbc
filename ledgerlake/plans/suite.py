"""The declared tests: which rule holds for which table, and one row for each with its violations.

Counts of absent or unlisted values take one pass a table; every other rule is a query of its own. Run them
over stored tables (see ``warehouse.materialize``), or each rule builds its table anew.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import checks
from ledgerlake.plans import assertions

# The declared rules.
NOT_NULL = {
    "fct_claim": ("claim_id", "npi", "date_day", "net_revenue"),
    "fct_lookup": ("lookup_id", "channel"),
    "dim_pharmacy": ("npi", "chain"),
    "dim_partner": ("partner",),
    "dim_drug": ("ndc",),
    "dim_date": ("date_day",),
    "slv_claims": ("claim_id", "chain"),
    "slv_reverts": ("claim_id",),
    "slv_claim_economics": ("claim_id",),
}
UNIQUE = {
    "fct_claim": "claim_id",
    "fct_lookup": "lookup_id",
    "dim_pharmacy": "npi",
    "dim_partner": "partner",
    "dim_drug": "ndc",
    "dim_date": "date_day",
    "slv_claims": "claim_id",
    "slv_reverts": "claim_id",
    "slv_claim_economics": "claim_id",
}
RELATIONSHIPS = (
    ("fct_claim", "npi", "dim_pharmacy"),
    ("fct_claim", "ndc", "dim_drug"),
    ("fct_claim", "partner", "dim_partner"),
    ("fct_claim", "date_day", "dim_date"),
    ("fct_lookup", "ndc", "dim_drug"),
    ("fct_lookup", "date_day", "dim_date"),
)
ACCEPTED = {"dim_partner": {"fee_type": ("flat", "percentage")}}
TABLES = tuple(dict.fromkeys([*NOT_NULL, "slv_nadac", "brz_claims", "brz_nadac"]))


def value_rules(name: str) -> dict[str, Column]:
    """What counts as a violation in a row of the table, by test."""
    rules = {f"{name}.{c}: not_null": F.col(c).isNull() for c in NOT_NULL.get(name, ())}
    return rules | {f"{name}.{c}: accepted_values": ~F.col(c).isin(*values) for c, values in ACCEPTED.get(name, {}).items()}


def row_rules(w) -> dict[str, Callable[[], DataFrame]]:
    """The violating rows of every other declared test."""
    rules: dict[str, Callable[[], DataFrame]] = {}
    for name, column in UNIQUE.items():
        rules[f"{name}.{column}: unique"] = lambda name=name, column=column: checks.unique(getattr(w, name), column)
    for child, column, parent in RELATIONSHIPS:
        rules[f"{child}.{column}: relationships"] = lambda child=child, column=column, parent=parent: checks.relationships(
            getattr(w, child), column, getattr(w, parent), column
        )
    streams = {name: (getattr(w, f"brz_{name}"), w.landing[name]) for name in ("claims", "lookups", "reverts")}
    return rules | {
        "slv_nadac.ndc, as_of_date: unique": lambda: checks.unique_combination(w.slv_nadac, ["ndc", "as_of_date"]),
        "bronze drops nothing": lambda: assertions.bronze_drops_nothing(streams),
        "bronze reconciles to silver": lambda: assertions.bronze_reconciles_to_silver(w.brz_claims, w.resolved_claims, w.slv_claims, w.slv_pharmacies),
        "claims have costs": lambda: assertions.claims_have_costs(w.fct_claim),
        "fee identity": lambda: assertions.fee_identity(w.fct_claim),
        "snapshots loaded": lambda: assertions.snapshots_loaded(w.brz_nadac),
        "partner fee within fee": lambda: assertions.partner_fee_within_fee(w.fct_claim),
        "partner terms exclusive": lambda: assertions.partner_terms_exclusive(w.dim_partner),
        "reverted claims count nothing": lambda: assertions.reverted_count_nothing(w.fct_claim),
    }


def run_tests(w) -> DataFrame:
    """(test, violations, passed): one row for each declared test of a warehouse."""
    parts = []
    for name in TABLES:
        if rules := value_rules(name):
            counts = getattr(w, name).agg(*(F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())))
            pairs = F.array(*(F.struct(F.lit(test).alias("test"), F.col(f"_{i}").alias("violations")) for i, test in enumerate(rules)))
            parts.append(counts.select(F.inline(pairs)))
    for test, violating in row_rules(w).items():
        parts.append(violating().agg(F.count(F.lit(1)).alias("violations")).select(F.lit(test).alias("test"), "violations"))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


def failures(results: DataFrame) -> Mapping[str, int]:
    """The tests that failed, with their violations; as many entries as declared tests at most."""
    return {r["test"]: r["violations"] for r in results.filter("NOT passed").collect()}
