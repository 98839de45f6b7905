"""Declared schemas: all-string landing, typed processed and output tables."""

from __future__ import annotations

from pyspark.sql import types as T

LANDING_FIELDS = (
    "transaction_id",
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "timestamp",
    "merchant_id",
    "location",
    "status",
)

# Every field is kept as text so malformed values survive long enough to be reported.
LANDING_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in LANDING_FIELDS]
    + [T.StructField("is_flagged", T.BooleanType(), True)]
)

AMOUNT_TYPE = T.DecimalType(12, 2)
# Aggregated money: wide enough for sums over 100 TB of transactions.
MONEY_SUM_TYPE = T.DecimalType(38, 2)
RISK_TYPE = T.DecimalType(3, 2)

PROCESSED_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("account_id", T.StringType(), True),
        T.StructField("transaction_type", T.StringType(), True),
        T.StructField("amount", AMOUNT_TYPE, True),
        T.StructField("currency", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("location", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("is_flagged", T.BooleanType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("transaction_date", T.DateType(), True),
        T.StructField("transaction_hour", T.IntegerType(), True),
        T.StructField("amount_bucket", T.StringType(), True),
        T.StructField("is_suspicious", T.BooleanType(), True),
        T.StructField("risk_score", RISK_TYPE, True),
    ]
)

SETTLEMENT_SCHEMA = T.StructType(
    [
        T.StructField("settlement_date", T.DateType(), True),
        T.StructField("transaction_type", T.StringType(), True),
        T.StructField("total_amount", MONEY_SUM_TYPE, True),
        T.StructField("avg_amount", AMOUNT_TYPE, True),
        T.StructField("transaction_count", T.LongType(), True),
        T.StructField("flagged_count", T.LongType(), True),
        T.StructField("running_total", MONEY_SUM_TYPE, True),
        T.StructField("day_over_day_change", MONEY_SUM_TYPE, True),
    ]
)

ALERT_COLUMNS = ("account_id", "alert_type", "alert_description", "transaction_count", "total_amount", "alert_date")

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.StringType(), True),
        T.StructField("alert_type", T.StringType(), True),
        T.StructField("alert_description", T.StringType(), True),
        T.StructField("transaction_count", T.LongType(), True),
        T.StructField("total_amount", MONEY_SUM_TYPE, True),
        T.StructField("alert_date", T.DateType(), True),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("record", LANDING_SCHEMA, True),
        T.StructField("errors", T.ArrayType(T.StringType(), True), True),
    ]
)
