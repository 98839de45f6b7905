"""Derived transaction columns (enrichment) as plain Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Rules
from ..schema import RISK_TYPE


def amount_bucket(amount: Column, rules: Rules) -> Column:
    # NULL amount falls through to "large", as in the reference.
    return (
        F.when(amount < rules.small_below, F.lit("small"))
        .when(amount <= rules.medium_upto, F.lit("medium"))
        .otherwise(F.lit("large"))
    )


def is_night(hour: Column, rules: Rules) -> Column:
    lo, hi = rules.night_hours
    return hour.between(lo, hi)


def is_suspicious(amount: Column, hour: Column, flagged: Column, rules: Rules) -> Column:
    """amount > limit OR night hour OR flagged; unknown counts as not suspicious."""
    return F.coalesce(
        (amount > rules.suspicious_amount) | is_night(hour, rules) | (flagged == F.lit(True)),
        F.lit(False),
    )


def risk_score(amount: Column, hour: Column, flagged: Column, bucket: Column, status: Column,
               rules: Rules) -> Column:
    """0.1 base + weighted conditions, capped at 1.0, as exact DECIMAL(3,2).

    Summed as integer tenths so no floating-point rounding is involved.
    """

    def tenths(cond: Column, n: int) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(n)).otherwise(F.lit(0))

    total = (
        F.lit(1)
        + tenths(amount > rules.suspicious_amount, 3)
        + tenths(is_night(hour, rules), 2)
        + tenths(flagged == F.lit(True), 2)
        + tenths(bucket == "large", 1)
        + tenths(status == "FAILED", 1)
    )
    return (F.least(total, F.lit(10)).cast("decimal(4,0)") / F.lit(10)).cast(RISK_TYPE)


def exact_mean(total: Column, count: Column, scale: int) -> Column:
    """round(total / count, scale) HALF_UP on exact decimals; NULL when count = 0.

    ``total`` is a sum of DECIMAL(x,2) values.  DECIMAL(22,2) / DECIMAL(20,0)
    divides at scale 18, far finer than any rounding tie needs.
    """
    q = total.cast("decimal(22,2)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, scale)


def exact_percent(part: Column, whole: Column) -> Column:
    """round(part / whole * 100, 2) HALF_UP on exact decimals; NULL when whole = 0."""
    q = (part * F.lit(100)).cast("decimal(22,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(q, 2).cast("decimal(10,2)")
