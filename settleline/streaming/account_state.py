"""Streaming HIGH_FREQUENCY, RAPID_SUCCESSION and HIGH_DAILY_AMOUNT from a per-second histogram.

The state is one row per (account, second): a streaming aggregation that Spark
pre-aggregates before the shuffle, so a busy account is spread over its seconds
and no group of raw rows is ever gathered.  Seconds behind the watermark leave
the state.  Each trigger's changed seconds are upserted into a table partitioned
by day; the alerts are the batch rules over that table's profile, exact over
everything that arrived on time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Rules
from ..operators import anomalies

#: Key and partitioning of the histogram table.
SECOND_KEYS = ["account_id", "sec"]
SECOND_PARTITION = ["day"]


def account_seconds(enriched: DataFrame) -> DataFrame:
    """(account_id, sec): rows, amount, amount of the first row in (ts, id) order (update mode)."""
    seconds = enriched.groupBy("account_id", F.window("event_time", "1 second").alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amt"),
        F.min(F.struct("ts", "transaction_id", "amount")).alias("first"),
    )
    sec = F.unix_seconds("w.start")
    return seconds.select("account_id", sec.alias("sec"), "n", "amt", F.col("first.amount").alias("first_amt"),
                          F.date_from_unix_date(F.floor(sec / F.lit(86400)).cast("int")).alias("day"))


def alerts_from_seconds(table: DataFrame, rules: Rules) -> DataFrame:
    """Alert rows from the upserted histogram table."""
    profile = anomalies.profile_of(table.drop("day"), rules)
    return anomalies.alerts_from_days(anomalies.account_days(profile, rules), rules)
