from conftest import base_record, uid
from settleline import api
from settleline.sources.landing import from_records


def _landing(spark):
    recs = [base_record(transaction_id=uid(i), amount=30000 if i < 2 else 10 + i,
                        timestamp=f"2024-06-0{1 + i % 2}T10:00:{i:02d}") for i in range(10)]
    recs.append(base_record(transaction_id=None))
    return from_records(spark, recs)


def test_validate_batch_shapes(spark, rules):
    valid, quarantine, report = api.validate_batch(_landing(spark), rules)
    assert valid.count() == 10 and quarantine.count() == 1
    r = report.first()
    assert (r["total"], r["valid"], r["invalid"]) == (11, 10, 1)


def test_process_batch_outputs_and_metrics(spark, rules, tmp_path):
    out = str(tmp_path / "out")
    result = api.process_batch(spark, _landing(spark), rules, output_path=out)
    assert set(result) == {"metrics", "transformed_df", "settlements_df", "anomalies_df"}
    m = result["metrics"]
    assert m["records_read"] == 11 and m["records_transformed"] == 10
    assert m["settlement_rows"] == result["settlements_df"].count() == 2
    assert m["anomalies_detected"] == result["anomalies_df"].count()
    assert {"transaction_date", "transaction_hour", "amount_bucket", "is_suspicious", "risk_score"} <= set(
        result["transformed_df"].columns)
    assert spark.read.parquet(f"{out}/processed").count() == 10
    dates = [r["settlement_date"] for r in result["settlements_df"].collect()]
    assert dates == sorted(dates)


def test_process_batch_lazy_without_output(spark, rules):
    result = api.process_batch(spark, _landing(spark), rules)
    assert set(result["metrics"]) == {"processing_time_sec"}
    assert result["anomalies_df"].columns == ["account_id", "alert_type", "alert_description", "transaction_count",
                                              "total_amount", "alert_date"]


def test_process_batch_from_records(spark, rules):
    import pytest

    recs = [base_record(transaction_id=uid(i)) for i in range(3)]
    assert api.process_batch(spark, rules=rules, records=recs)["transformed_df"].count() == 3
    with pytest.raises(ValueError):
        api.process_batch(spark, rules=rules)


def test_texts_follow_the_thresholds(spark, rules):
    strict = rules.with_(max_amount=500, daily_amount_limit=100, rapid_gap_sec=10, burst_min_exclusive=2, burst_window_sec=1800)
    recs = [base_record(transaction_id=uid(i), amount=60, timestamp=f"2024-06-01T10:00:{i:02d}") for i in range(4)]
    recs.append(base_record(transaction_id=uid(9), amount=600))
    _, bad, _ = api.validate_batch(from_records(spark, recs), strict)
    assert bad.first()["errors"] == ["amount exceeds maximum (500): 600.0"]
    texts = {r["alert_type"]: r["alert_description"] for r in api.process_batch(spark, from_records(spark, recs), strict)["anomalies_df"].collect()}
    assert texts == {"HIGH_FREQUENCY": "Account had 4 transactions in a 30-minute window",
                     "HIGH_DAILY_AMOUNT": "Account exceeded $100 daily threshold with $240.00",
                     "RAPID_SUCCESSION": "Account had 3 rapid successive transactions (< 10s apart)"}
