import pytest

from conftest import base_record, uid
from settleline.operators import validate
from settleline.sources.landing import from_records


def errors_of(spark, rules, **overrides):
    df = validate.with_errors(from_records(spark, [base_record(**overrides)]), rules)
    row = df.select("is_valid", "errors").first()
    return row["is_valid"], list(row["errors"])


def test_valid_record_passes(spark, rules):
    assert errors_of(spark, rules) == (True, [])


@pytest.mark.parametrize(
    "overrides, expected",
    [
        ({"transaction_id": None}, "transaction_id is missing or null"),
        ({"transaction_id": ""}, "transaction_id is missing or null"),
        ({"transaction_id": "not-a-uuid"}, "transaction_id is not a valid UUID: not-a-uuid"),
        ({"amount": -50.0}, "amount must be positive, got -50.0"),
        ({"amount": 0}, "amount must be positive, got 0.0"),
        ({"amount": 150000.0}, "amount exceeds maximum (100,000): 150000.0"),
        ({"amount": 100000}, "amount exceeds maximum (100,000): 100000.0"),
        ({"amount": 15000000.0}, "amount exceeds maximum (100,000): 15000000.0"),
        ({"amount": "abc"}, "amount is not a valid number: abc"),
        ({"amount": ""}, "amount is not a valid number: "),
        ({"amount": "NaN"}, "amount is not a valid number: NaN"),
        ({"amount": "12.5d"}, "amount is not a valid number: 12.5d"),
        ({"amount": "inf"}, "amount exceeds maximum (100,000): inf"),
        ({"amount": "-inf"}, "amount must be positive, got -inf"),
        ({"amount": None}, "amount is missing or null"),
        ({"account_id": "WRONG_FORMAT"}, "account_id does not match ACC_XXXXX pattern: WRONG_FORMAT"),
        ({"account_id": "ACC_00001\n"}, "account_id does not match ACC_XXXXX pattern: ACC_00001\n"),
        ({"account_id": None}, "account_id is missing or null"),
        ({"timestamp": "2025-01-11T00:00:00"}, "timestamp is in the future: 2025-01-11T00:00:00"),
        ({"timestamp": "not-a-timestamp"}, "timestamp is not valid ISO format: not-a-timestamp"),
        ({"timestamp": "2024-06-01T11:00:00Z"}, "timestamp is not valid ISO format: 2024-06-01T11:00:00Z"),
        ({"timestamp": "2024-06-01T11:00:00+02:00"}, "timestamp is not valid ISO format: 2024-06-01T11:00:00+02:00"),
        ({"timestamp": "2026"}, "timestamp is not valid ISO format: 2026"),
        ({"timestamp": "2024-13-01"}, "timestamp is not valid ISO format: 2024-13-01"),
        ({"transaction_type": "INVALID_TYPE"}, "transaction_type is invalid: INVALID_TYPE"),
        ({"currency": "TOOLONG"}, "currency is not a valid 3-letter code: TOOLONG"),
        ({"currency": "usd"}, "currency is not a valid 3-letter code: usd"),
        ({"currency": None}, "currency is missing or null"),
    ],
)
def test_single_rule_failures(spark, rules, overrides, expected):
    ok, errors = errors_of(spark, rules, **overrides)
    assert ok is False
    assert errors == [expected]


@pytest.mark.parametrize("amount", [99999.99, 0.01, " 250 ", "1_000", "1e3", ".5"])
def test_amount_accepted(spark, rules, amount):
    assert errors_of(spark, rules, amount=amount) == (True, [])


@pytest.mark.parametrize("ts", ["2024-06-01", "2024-06-01 11:00", "2024-06-01T11", "2024-06-01T11:00:00.123456"])
def test_iso_forms_accepted(spark, rules, ts):
    assert errors_of(spark, rules, timestamp=ts) == (True, [])


def test_uuid_is_case_insensitive(spark, rules):
    assert errors_of(spark, rules, transaction_id=uid(5).upper())[0] is True


def test_multiple_errors_in_rule_order(spark, rules):
    ok, errors = errors_of(spark, rules, transaction_id=None, amount=-100, account_id="bad")
    assert ok is False
    assert errors == [
        "transaction_id is missing or null",
        "amount must be positive, got -100.0",
        "account_id does not match ACC_XXXXX pattern: bad",
    ]


def _report(spark, rules, records):
    row = validate.report(from_records(spark, records), rules).first()
    return row.asDict(recursive=True)


def test_all_valid_batch(spark, rules):
    r = _report(spark, rules, [base_record(transaction_id=uid(i)) for i in range(10)])
    assert (r["total"], r["valid"], r["invalid"], float(r["valid_rate"])) == (10, 10, 0, 100.0)
    assert r["error_breakdown"] == {}


def test_mixed_batch_and_breakdown(spark, rules):
    recs = [base_record(transaction_id=uid(i)) for i in range(8)]
    recs += [base_record(transaction_id=None), base_record(transaction_id=uid(99), amount=-1)]
    r = _report(spark, rules, recs)
    assert (r["total"], r["valid"], r["invalid"], float(r["valid_rate"])) == (10, 8, 2, 80.0)
    assert r["error_breakdown"] == {"transaction_id": 1, "amount": 1}
    long = {x["category"]: x["error_count"] for x in
            validate.error_breakdown(from_records(spark, recs), rules).collect()}
    assert long == {"transaction_id": 1, "amount": 1}


def test_empty_batch_reports_zero(spark, rules):
    r = _report(spark, rules, [])
    assert (r["total"], r["valid"], r["invalid"], float(r["valid_rate"])) == (0, 0, 0, 0.0)


def test_split_and_quarantine(spark, rules):
    recs = [base_record(transaction_id=uid(1)), base_record(transaction_id=None, currency="TOOLONG")]
    checked = validate.with_errors(from_records(spark, recs), rules)
    assert validate.valid_rows(checked).count() == 1
    q = validate.quarantine(checked).collect()
    assert len(q) == 1
    assert q[0]["record"]["currency"] == "TOOLONG"
    assert list(q[0]["errors"]) == ["transaction_id is missing or null",
                                    "currency is not a valid 3-letter code: TOOLONG"]
    assert validate.valid_landing(from_records(spark, recs), rules).count() == 1


def test_report_from_observed_metrics(spark, rules):
    from pyspark.sql import Observation
    recs = [base_record(transaction_id=uid(1)), base_record(transaction_id="x")]
    obs = Observation("v")
    from_records(spark, recs).observe(obs, *validate.report_columns(rules)).write.format("noop").mode("overwrite").save()
    r = validate.report_from_metrics(obs.get)
    assert r == {"total": 2, "valid": 1, "invalid": 1, "valid_rate": 50.0, "error_breakdown": {"transaction_id": 1}}


@pytest.mark.parametrize(
    "field, value",
    [("amount", v) for v in ["1e400", "-0", "0.001", "99999.999999", "1__0", "_1", "1_", "+.5", "5e-324", " NaN ",
                             "Infinity", "0x10", "1,000", "٣"]]
    + [("timestamp", v) for v in ["2024-06-01T11:00:00.", "2024-06-01T11:00:60", "2024-02-30", " 2024-06-01",
                                  "2024-06-01T11:00:00.1234567890", "2024-6-01"]]
    + [("transaction_id", v) for v in [" ", uid(1) + "\n", uid(1)[:-1] + "G"]]
    + [("currency", v) for v in ["US", "USDX", "ÜSD", ""]]
    + [("transaction_type", v) for v in ["refund", "REFUND ", ""]],
)
def test_boolean_validity_agrees_with_messages(spark, rules, field, value):
    df = validate.with_errors(from_records(spark, [base_record(**{field: value})]), rules)
    row = df.select("is_valid", "errors").first()
    assert row["is_valid"] == (len(row["errors"]) == 0)


def test_corrupt_records_keep_their_text(spark, rules, tmp_path):
    import json

    from settleline.operators import validate
    from settleline.plans.pipeline import run_batch
    from settleline.sources import landing

    good, bad = base_record(transaction_id=uid(1)), '{"transaction_id": "x", "acc'
    (tmp_path / "in.json").write_text(json.dumps(good) + "\n" + bad + "\n" + json.dumps(base_record(transaction_id=None)) + "\n")
    rows = landing.read_json_lines(spark, str(tmp_path / "in.json"), keep_corrupt=True)
    q = validate.quarantine(validate.with_errors(rows, rules)).collect()
    assert sorted(r["raw_text"] or "" for r in q) == ["", bad]
    assert all(r["errors"] for r in q)
    res = run_batch(spark, rows, str(tmp_path / "wh"), rules, batch_id="c")
    stored = spark.read.parquet(res.paths["quarantine"])
    assert bad in [r["raw_text"] for r in stored.collect()] and "_corrupt_record" not in spark.read.parquet(res.paths["raw_transactions"]).columns
    values = spark.createDataFrame([(bad,), (json.dumps(good),)], "value string")
    assert [r["_corrupt_record"] for r in landing.from_json_values(values, keep_corrupt=True).collect()] == [bad, None]
