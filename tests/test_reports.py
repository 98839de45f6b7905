from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import base_record, uid
from settleline.operators import anomalies, enrich, reports, settle, validate
from settleline.sources.landing import from_records

TYPES = ["REFUND", "FEE_CHARGE", "ACCOUNT_DEPOSIT"]


def processed_of(spark, rules, records):
    return enrich.processed(validate.valid_landing(from_records(spark, records), rules), rules)


def patterned(n_accounts=3, n=300):
    base, recs, i = datetime(2024, 6, 1, 0, 0, 0), [], 0
    for a in range(n_accounts):
        for k in range(n):
            ts = base + timedelta(seconds=(k * 613 + a * 97) % 30000)
            amount = [5, 40, 300, 2000, 3, 7000][(k * 7 + a) % 6] + (k % 5)
            recs.append(base_record(transaction_id=uid(i), account_id=f"ACC_{a + 1:05d}", timestamp=ts.isoformat(),
                                    amount=amount, transaction_type=TYPES[(k // 2 + a) % 3],
                                    status="FAILED" if k % 9 == 0 else "COMPLETED"))
            i += 1
    return recs


def plain_patterns(processed):
    w = Window.partitionBy("account_id").orderBy("ts", "transaction_id")
    p = processed.select(
        "account_id", "amount", "transaction_type", "risk_score",
        F.lag("amount").over(w).alias("pa"), F.lead("amount").over(w).alias("na"),
        F.lag("transaction_type").over(w).alias("pt"))
    flags = p.select(
        "account_id", "risk_score",
        F.coalesce(F.col("transaction_type") == F.col("pt"), F.lit(False)).alias("rep"),
        ((F.col("amount") > F.coalesce("pa", F.lit(0))) & (F.coalesce("na", F.lit(0)) > F.col("amount"))).alias("esc"),
        F.coalesce(F.abs(F.col("amount") - F.col("pa")) / F.nullif(F.col("pa"), F.lit(0)) > 5, F.lit(False)).alias("dev"))
    return {r["account_id"]: (r["n"], r["rep"], r["esc"], r["dev"]) for r in flags.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("rep").alias("rep"), F.count_if("esc").alias("esc"),
        F.count_if("dev").alias("dev")).collect()}


@pytest.mark.parametrize("bucket", [60, 600, 3600, 100000])
def test_account_patterns_bucketed_equals_plain(spark, rules, bucket):
    processed = processed_of(spark, rules, patterned())
    got = reports.account_patterns(processed, rules.with_(pattern_bucket_sec=bucket), k=100).collect()
    expected = {k: v for k, v in plain_patterns(processed).items() if v[1] > 2 or v[2] > 1 or v[3] > 0}
    assert {r["account_id"]: (r["total_transactions"], r["repeated_type_count"], r["escalating_count"],
                              r["deviation_count"]) for r in got} == expected


def test_top_accounts_alert_join(spark, rules):
    recs = [base_record(transaction_id=uid(i), account_id="ACC_00009", amount=30000,
                        timestamp=f"2024-06-01T10:00:{i:02d}") for i in range(3)]
    recs += [base_record(transaction_id=uid(10), account_id="ACC_00002", amount=5)]
    processed = processed_of(spark, rules, recs)
    out = {r["account_id"]: r for r in
           reports.top_accounts(processed, anomalies.detect_anomalies(processed, rules)).collect()}
    assert out["ACC_00009"]["alert_types"] == "HIGH_DAILY_AMOUNT, RAPID_SUCCESSION"
    assert out["ACC_00009"]["alert_count"] == 2
    assert out["ACC_00002"]["alert_types"] == "NONE" and out["ACC_00002"]["alert_count"] == 0
    assert out["ACC_00009"]["active_days"] == 1


def test_hourly_risk_bands(spark, rules):
    recs = [base_record(transaction_id=uid(i), amount=10, timestamp="2024-06-01T03:00:00") for i in range(2)]
    recs += [base_record(transaction_id=uid(10 + i), amount=10, is_flagged=(i == 0),
                         timestamp="2024-06-01T12:00:00") for i in range(8)]
    out = {r["transaction_hour"]: r for r in reports.hourly_risk(processed_of(spark, rules, recs)).collect()}
    assert out[3]["anomaly_rate_pct"] == Decimal("100.00") and out[3]["risk_level"] == "HIGH RISK"
    assert out[12]["anomaly_rate_pct"] == Decimal("12.50") and out[12]["risk_level"] == "MEDIUM RISK"


def test_merchant_risk_ranks_ties(spark, rules):
    recs, i = [], 0
    for m, flagged in (("MER_0001", 1), ("MER_0002", 1), ("MER_0003", 0), ("MER_0004", 5)):
        for k in range(5):
            recs.append(base_record(transaction_id=uid(i), merchant_id=m, amount=10, is_flagged=k < flagged))
            i += 1
    recs.append(base_record(transaction_id=uid(999), merchant_id="MER_0005"))  # < 5 rows: excluded
    out = [(r["merchant_id"], r["risk_rank"], r["risk_dense_rank"])
           for r in reports.merchant_risk(processed_of(spark, rules, recs)).orderBy("risk_rank", "merchant_id").collect()]
    assert out == [("MER_0004", 1, 1), ("MER_0001", 2, 2), ("MER_0002", 2, 2), ("MER_0003", 4, 3)]


def test_settlement_summary_pct(spark, rules):
    recs = [base_record(transaction_id=uid(1), amount=200, timestamp="2024-01-01T10:00:00"),
            base_record(transaction_id=uid(2), amount=150, timestamp="2024-01-02T10:00:00")]
    out = reports.settlement_summary(settle.daily_settlements(processed_of(spark, rules, recs)))
    rows = sorted(out.collect(), key=lambda r: r["settlement_date"])
    assert rows[0]["dod_pct_change"] is None
    assert rows[1]["dod_change"] == Decimal("-50.00") and rows[1]["dod_pct_change"] == Decimal("-25.00")


def test_top_reports_come_in_order(spark, rules):
    recs = [base_record(transaction_id=uid(i), account_id=f"ACC_{1 + i % 40:05d}", merchant_id=f"MER_{1 + i % 40:04d}",
                        amount=10 + (i * 131) % 700, is_flagged=i % 3 == 0, timestamp=f"2024-06-01T12:{i % 60:02d}:00") for i in range(400)]
    processed = processed_of(spark, rules, recs)
    top = reports.top_accounts(processed, anomalies.detect_anomalies(processed, rules))
    rows = [(-r["total_volume"], r["account_id"]) for r in top.collect()]
    assert len(rows) == 10 and rows == sorted(rows)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "RightOuter" not in plan and "Sort [" in plan
    rows = [(r["risk_rank"], r["merchant_id"]) for r in reports.merchant_risk(processed).collect()]
    assert len(rows) == 20 and rows == sorted(rows)
