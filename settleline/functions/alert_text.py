"""Texts of the three alerts, one place for each; thresholds come from the rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Rules
from ..schema import MONEY_SUM_TYPE


def span_name(seconds: int) -> str:
    """3600 -> "1-hour", 600 -> "10-minute", 45 -> "45-second"."""
    for unit, size in (("hour", 3600), ("minute", 60)):
        if seconds % size == 0:
            return f"{seconds // size}-{unit}"
    return f"{seconds}-second"


def high_frequency(count: Column, rules: Rules) -> Column:
    return F.concat(F.lit("Account had "), count.cast("string"),
                    F.lit(f" transactions in a {span_name(rules.burst_window_sec)} window"))


def high_daily_amount(total: Column, rules: Rules) -> Column:
    return F.concat(F.lit(f"Account exceeded ${rules.daily_amount_limit:,} daily threshold with $"),
                    F.round(total, 2).cast(MONEY_SUM_TYPE).cast("string"))


def rapid_succession(count: Column, rules: Rules) -> Column:
    return F.concat(F.lit("Account had "), count.cast("string"),
                    F.lit(f" rapid successive transactions (< {rules.rapid_gap_sec}s apart)"))
