"""Daily settlements: per (date, type) totals, running total and day-over-day change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import exact_mean
from ..schema import AMOUNT_TYPE, MONEY_SUM_TYPE


def daily_totals(processed: DataFrame) -> DataFrame:
    """group by (transaction_date, transaction_type): sum, mean, count, flagged count.

    Partial aggregation runs map-side, so the shuffle carries at most one row
    per (date, type) per task whatever the input size or key skew.
    """
    return (
        processed.groupBy(F.col("transaction_date").alias("settlement_date"), "transaction_type")
        .agg(
            F.sum("amount").alias("_sum"),
            F.count(F.lit(1)).alias("transaction_count"),
            F.count_if(F.col("is_flagged") == F.lit(True)).alias("flagged_count"),
        )
        .select(
            "settlement_date",
            "transaction_type",
            F.col("_sum").cast(MONEY_SUM_TYPE).alias("total_amount"),
            exact_mean(F.col("_sum"), F.col("transaction_count"), 2).cast(AMOUNT_TYPE).alias("avg_amount"),
            "transaction_count",
            "flagged_count",
        )
    )


def with_running_columns(totals: DataFrame) -> DataFrame:
    """running_total (rows frame) and day_over_day_change (lag) per type, in date order.

    Runs on the aggregated table (days x types rows), so the single window
    exchange is tiny; both columns share one sort.  A missing day is not filled:
    the change is against the previous present date.
    """
    by_type = Window.partitionBy("transaction_type").orderBy("settlement_date")
    running = by_type.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.select(
        *totals.columns,
        F.sum("total_amount").over(running).cast(MONEY_SUM_TYPE).alias("running_total"),
        (F.col("total_amount") - F.lag("total_amount", 1).over(by_type))
        .cast(MONEY_SUM_TYPE)
        .alias("day_over_day_change"),
    )


def daily_settlements(processed: DataFrame, ordered: bool = False) -> DataFrame:
    """Settlement table; ``ordered`` sorts by (date, type) for presentation only
    (never needed before a write)."""
    out = with_running_columns(daily_totals(processed))
    return out.orderBy("settlement_date", "transaction_type") if ordered else out
