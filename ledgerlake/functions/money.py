"""Fee split, net measures, safe ratios and report rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def partner_fee_share(fee: Column, flat_cents: Column, percentage: Column) -> Column:
    """The partner's part of a fee in dollars.

    A flat term is in cents and capped at the fee; zero cents is a term, not a gap. A percentage
    term takes that part of the fee. Without a term the share is zero.
    """
    return (
        F.when(flat_cents.isNotNull(), F.least(flat_cents / F.lit(100.0), fee))
        .when(percentage.isNotNull(), fee * (percentage / F.lit(100.0)))
        .otherwise(F.lit(0.0))
    )


def fee_type(flat_cents: Column, percentage: Column) -> Column:
    """Which kind of term is in force, judged by NULL-ness only."""
    return F.when(flat_cents.isNotNull(), "flat").when(percentage.isNotNull(), "percentage").otherwise("undefined")


def net_measures(void: Column, pairs: dict[str, str]) -> list[Column]:
    """One ``net`` column per gross column: zero where the row is void, else the gross value.

    An unknown (NULL) gross value stays unknown on a live row and is zero on a void one.
    """
    return [F.when(void, F.lit(0.0)).otherwise(F.col(gross)).alias(net) for net, gross in pairs.items()]


def count_true(flag: Column) -> Column:
    """How many rows have the flag set; NULL counts as not set."""
    return F.coalesce(F.sum(flag.cast("bigint")), F.lit(0).cast("bigint"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in double, NULL where whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def round_total(total: Column, digits: int = 2) -> Column:
    """Round a sum for a report.

    Spark does not fix the order of additions, so the last bits of a double total differ from run to
    run. Rounding two digits finer first keeps that noise from flipping a half cent.
    """
    return F.round(F.round(total, digits + 2), digits)


def round_ratio(value: Column, digits: int) -> Column:
    """Round a quotient for a report; same idea, with the noise of a quotient being far smaller."""
    return F.round(F.round(value, digits + 6), digits)
