"""Typed projection, redelivery de-duplication and enrichment of valid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Rules
from ..functions import derive
from ..functions.parsing import parse_amount, parse_timestamp
from ..schema import LANDING_FIELDS


def typed(valid: DataFrame) -> DataFrame:
    """Valid landing rows -> typed rows: amount DECIMAL(12,2), ts TIMESTAMP_NTZ."""
    return valid.select(
        *[F.col(c) for c in LANDING_FIELDS if c != "amount"],
        "is_flagged",
        parse_amount(F.col("amount")).alias("amount"),
        parse_timestamp(F.col("timestamp")).alias("ts"),
    ).select(
        "transaction_id", "account_id", "transaction_type", "amount", "currency", "timestamp",
        "merchant_id", "location", "status", "is_flagged", "ts",
    )


def first_delivery(rows: DataFrame, key: str = "transaction_id", order_by: str = "ts") -> DataFrame:
    """Keep one row per ``key``: the earliest by (``order_by``, then the remaining columns).

    Deterministic "first wins".  Implemented as a grouped ``min`` over a struct
    whose leading field is the ordering, so the map side pre-aggregates
    (a key redelivered a million times costs one row per task in the shuffle).
    """
    others = [c for c in rows.columns if c not in (key, order_by)]
    best = F.min(F.struct(F.col(order_by), *[F.col(c) for c in others])).alias("_first")
    return rows.groupBy(key).agg(best).select(key, "_first.*").select(*rows.columns)


def with_burst_flag(processed: DataFrame, rules: Rules, window_sec: int = 60, min_exclusive: int = 5) -> DataFrame:
    """Opt-in design-document rule: also suspicious when the account has more than
    ``min_exclusive`` transactions in the trailing ``window_sec`` seconds.

    Trailing counts come from the halo-bucketed per-second histogram (see
    ``operators.anomalies``) joined back on (account_id, second), so a busy
    account is never gathered into one task.
    """
    from .anomalies import second_profile, with_epoch

    burst_rules = rules.with_(burst_window_sec=window_sec, rapid_gap_sec=1)
    counts = second_profile(processed, burst_rules).select(
        "account_id", "sec", (F.col("trailing_n") > min_exclusive).alias("_burst"))
    joined = with_epoch(processed).join(counts, ["account_id", "sec"], "left")
    return joined.withColumn("is_suspicious", F.col("is_suspicious") | F.coalesce("_burst", F.lit(False))).select(
        *processed.columns)


def enrich(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add transaction_date, transaction_hour, amount_bucket, is_suspicious, risk_score."""
    amount, flagged, status = F.col("amount"), F.col("is_flagged"), F.col("status")
    hour = F.hour("ts")
    bucket = derive.amount_bucket(amount, rules)
    return rows.select(
        *rows.columns,
        F.to_date("ts").alias("transaction_date"),
        hour.alias("transaction_hour"),
        bucket.alias("amount_bucket"),
        derive.is_suspicious(amount, hour, flagged, rules).alias("is_suspicious"),
        derive.risk_score(amount, hour, flagged, bucket, status, rules).alias("risk_score"),
    )


def processed(valid: DataFrame, rules: Rules) -> DataFrame:
    """valid landing rows -> (de-duplicated) typed, enriched rows."""
    rows = typed(valid)
    if rules.dedupe:
        rows = first_delivery(rows)
    return enrich(rows, rules)
