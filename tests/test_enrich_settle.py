from decimal import Decimal

import pytest

from conftest import base_record, uid
from settleline.operators import enrich, settle, validate
from settleline.sources.landing import from_records


def processed_of(spark, rules, records):
    return enrich.processed(validate.valid_landing(from_records(spark, records), rules), rules)


@pytest.mark.parametrize("amount, bucket", [(99.99, "small"), (100, "medium"), (1000, "medium"), (1000.01, "large")])
def test_amount_bucket_edges(spark, rules, amount, bucket):
    row = processed_of(spark, rules, [base_record(amount=amount)]).first()
    assert row["amount_bucket"] == bucket


@pytest.mark.parametrize("clock, expected", [("00:59:59", False), ("01:00:00", True), ("05:59:59", True),
                                              ("06:00:00", False)])
def test_suspicious_night_hours(spark, rules, clock, expected):
    row = processed_of(spark, rules, [base_record(amount=10, timestamp=f"2024-06-01T{clock}")]).first()
    assert row["is_suspicious"] is expected


@pytest.mark.parametrize("amount, expected", [(5000, False), (5000.01, True)])
def test_suspicious_amount(spark, rules, amount, expected):
    row = processed_of(spark, rules, [base_record(amount=amount, timestamp="2024-06-01T12:00:00")]).first()
    assert row["is_suspicious"] is expected


def test_flagged_is_suspicious(spark, rules):
    row = processed_of(spark, rules, [base_record(amount=10, is_flagged=True)]).first()
    assert row["is_suspicious"] is True


@pytest.mark.parametrize(
    "overrides, score",
    [
        ({"amount": 10, "timestamp": "2024-06-01T12:00:00"}, "0.10"),
        ({"amount": 6000, "timestamp": "2024-06-01T03:00:00", "is_flagged": True, "status": "FAILED"}, "1.00"),
        ({"amount": 6000, "timestamp": "2024-06-01T12:00:00"}, "0.50"),
        ({"amount": 2000, "timestamp": "2024-06-01T12:00:00", "status": "FAILED"}, "0.30"),
    ],
)
def test_risk_score(spark, rules, overrides, score):
    row = processed_of(spark, rules, [base_record(**overrides)]).first()
    assert row["risk_score"] == Decimal(score)


def test_derived_types_and_values(spark, rules):
    row = processed_of(spark, rules, [base_record(amount="250.005", timestamp="2024-06-01T23:59:59.5")]).first()
    assert row["amount"] == Decimal("250.01")  # HALF_UP to cents
    assert str(row["transaction_date"]) == "2024-06-01"
    assert row["transaction_hour"] == 23


def test_first_delivery_keeps_earliest(spark, rules):
    recs = [
        base_record(transaction_id=uid(1), timestamp="2024-06-01T12:00:05", amount=20),
        base_record(transaction_id=uid(1), timestamp="2024-06-01T12:00:01", amount=10),
        base_record(transaction_id=uid(2), amount=30),
    ]
    rows = {r["transaction_id"]: r for r in processed_of(spark, rules, recs).collect()}
    assert len(rows) == 2
    assert rows[uid(1)]["amount"] == Decimal("10.00")
    no_dedupe = enrich.processed(validate.valid_landing(from_records(spark, recs), rules), rules.with_(dedupe=False))
    assert no_dedupe.count() == 3


def test_daily_settlements_running_and_change(spark, rules):
    recs = [
        base_record(transaction_id=uid(1), transaction_type="REFUND", amount=100, timestamp="2024-01-01T10:00:00"),
        base_record(transaction_id=uid(2), transaction_type="REFUND", amount=200, timestamp="2024-01-02T10:00:00",
                    is_flagged=True),
        base_record(transaction_id=uid(3), transaction_type="REFUND", amount=50, timestamp="2024-01-02T11:00:00"),
        base_record(transaction_id=uid(4), transaction_type="REFUND", amount=50, timestamp="2024-01-04T10:00:00"),
        base_record(transaction_id=uid(5), transaction_type="FEE_CHARGE", amount=7, timestamp="2024-01-02T10:00:00"),
    ]
    out = settle.daily_settlements(processed_of(spark, rules, recs))
    rows = {(str(r["settlement_date"]), r["transaction_type"]): r for r in out.collect()}
    refunds = [rows[(d, "REFUND")] for d in ("2024-01-01", "2024-01-02", "2024-01-04")]
    assert [r["total_amount"] for r in refunds] == [Decimal("100.00"), Decimal("250.00"), Decimal("50.00")]
    assert [r["running_total"] for r in refunds] == [Decimal("100.00"), Decimal("350.00"), Decimal("400.00")]
    assert [r["day_over_day_change"] for r in refunds] == [None, Decimal("150.00"), Decimal("-200.00")]
    assert refunds[1]["avg_amount"] == Decimal("125.00")
    assert refunds[1]["flagged_count"] == 1 and refunds[1]["transaction_count"] == 2
    assert rows[("2024-01-02", "FEE_CHARGE")]["running_total"] == Decimal("7.00")


def test_mean_rounds_half_up(spark, rules):
    recs = [base_record(transaction_id=uid(1), amount=10.00), base_record(transaction_id=uid(2), amount=10.01)]
    row = settle.daily_settlements(processed_of(spark, rules, recs)).first()
    assert row["avg_amount"] == Decimal("10.01")  # 10.005 -> 10.01


def test_empty_input_gives_empty_settlements(spark, rules):
    out = settle.daily_settlements(processed_of(spark, rules, []))
    assert out.count() == 0
    assert out.columns == ["settlement_date", "transaction_type", "total_amount", "avg_amount",
                           "transaction_count", "flagged_count", "running_total", "day_over_day_change"]
