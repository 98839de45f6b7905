from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import base_record, uid
from settleline.operators import anomalies, enrich, validate
from settleline.sources.landing import from_records

T0 = datetime(2024, 6, 1, 10, 0, 0)


def processed_of(spark, rules, records):
    return enrich.processed(validate.valid_landing(from_records(spark, records), rules), rules)


def rec(i, seconds, amount=10.0, account="ACC_00001", base=T0):
    ts = (base + timedelta(seconds=seconds)).isoformat()
    return base_record(transaction_id=uid(i), timestamp=ts, amount=amount, account_id=account)


def alerts_by_type(df):
    return {(r["alert_type"], r["account_id"], r["alert_date"]): r for r in df.collect()}


def test_high_frequency_inclusive_hour(spark, rules):
    recs = [rec(i, i * 360, amount=1 + i) for i in range(11)]  # t0 .. t0+3600 inclusive, 11 rows
    out = anomalies.high_frequency(processed_of(spark, rules, recs), rules).collect()
    assert len(out) == 1
    assert out[0]["transaction_count"] == 11
    assert out[0]["total_amount"] == Decimal("11.00")  # only the 11th row is over the limit
    assert out[0]["alert_description"] == "Account had 11 transactions in a 1-hour window"


def test_high_frequency_just_outside(spark, rules):
    recs = [rec(i, i * 360, amount=1 + i) for i in range(10)] + [rec(10, 3601)]
    assert anomalies.high_frequency(processed_of(spark, rules, recs), rules).count() == 0


def test_high_frequency_same_second_peers(spark, rules):
    recs = [rec(i, 0, amount=1) for i in range(11)]
    out = anomalies.high_frequency(processed_of(spark, rules, recs), rules).collect()
    assert out[0]["transaction_count"] == 11 and out[0]["total_amount"] == Decimal("11.00")


def test_high_daily_amount(spark, rules):
    recs = [
        rec(1, 0, amount=25000.00, account="ACC_00002"), rec(2, 60, amount=25000.00, account="ACC_00002"),
        rec(3, 0, amount=25000.00, account="ACC_00003"), rec(4, 60, amount=25000.01, account="ACC_00003"),
        rec(5, 86400, amount=60000, account="ACC_00003"),
    ]
    out = alerts_by_type(anomalies.high_daily_amount(processed_of(spark, rules, recs), rules))
    assert set(out) == {("HIGH_DAILY_AMOUNT", "ACC_00003", T0.date()),
                        ("HIGH_DAILY_AMOUNT", "ACC_00003", (T0 + timedelta(days=1)).date())}
    first = out[("HIGH_DAILY_AMOUNT", "ACC_00003", T0.date())]
    assert first["alert_description"] == "Account exceeded $50,000 daily threshold with $50000.01"
    assert first["transaction_count"] == 2


def test_rapid_succession_gaps(spark, rules):
    # gaps 0 s, 29 s, 30 s after the first row -> the 0 s and 29 s rows count
    recs = [rec(1, 0, 1), rec(2, 0, 2), rec(3, 29, 4), rec(4, 59, 8)]
    out = anomalies.rapid_succession(processed_of(spark, rules, recs), rules).collect()
    assert len(out) == 1
    assert out[0]["transaction_count"] == 2
    assert out[0]["total_amount"] == Decimal("6.00")


def test_rapid_succession_same_second_order(spark, rules):
    # same second: the first row by (ts, transaction_id) is not counted
    recs = [rec(2, 0.5, 5), rec(1, 0.2, 7), rec(3, 100, 1)]
    out = anomalies.rapid_succession(processed_of(spark, rules, recs), rules).collect()
    assert out[0]["transaction_count"] == 1
    assert out[0]["total_amount"] == Decimal("5.00")


def test_empty_alerts_have_schema(spark, rules):
    out = anomalies.detect_anomalies(processed_of(spark, rules, []), rules)
    assert out.count() == 0
    assert out.columns == ["account_id", "alert_type", "alert_description", "transaction_count",
                           "total_amount", "alert_date"]


def _plain_reference(processed):
    """Per-row windows over whole accounts (the small-data definition)."""
    sec = F.unix_seconds(F.to_timestamp(F.col("ts")))
    p = processed.withColumn("sec", sec)
    trailing = Window.partitionBy("account_id").orderBy("sec").rangeBetween(-3600, 0)
    ordered = Window.partitionBy("account_id").orderBy("ts", "transaction_id")
    return p.select(
        "transaction_id", "account_id", "amount",
        F.count(F.lit(1)).over(trailing).alias("c"),
        (F.col("sec") - F.lag("sec").over(ordered)).alias("gap"),
    )


@pytest.mark.parametrize("bucket", [3600, 7200, 86400])
def test_histogram_halo_equals_plain_windows(spark, rules, bucket):
    # dense bursts around bucket edges (midnight and on-the-hour) for two accounts
    base = datetime(2024, 6, 1, 22, 50, 0)
    recs, i = [], 0
    for acc in ("ACC_00001", "ACC_00002"):
        for k in range(400):
            recs.append(rec(i, (k * 37) % 9000 + (k % 3), amount=1 + (k % 17), account=acc, base=base))
            i += 1
    processed = processed_of(spark, rules, recs)
    r = rules.with_(histogram_bucket_sec=bucket)
    plain = _plain_reference(processed)
    hf_plain = {
        x["account_id"]: (x["m"], x["s"]) for x in
        plain.filter("c > 10").groupBy("account_id").agg(F.max("c").alias("m"), F.sum("amount").alias("s")).collect()
    }
    hf = {x["account_id"]: (x["transaction_count"], x["total_amount"]) for x in
          anomalies.high_frequency(processed, r).collect()}
    assert hf == hf_plain
    rs_plain = {
        x["account_id"]: (x["n"], x["s"]) for x in
        plain.filter("gap IS NOT NULL AND gap < 30").groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")).collect()
    }
    rs = {x["account_id"]: (x["transaction_count"], x["total_amount"]) for x in
          anomalies.rapid_succession(processed, r).collect()}
    assert rs == rs_plain
    per_row = {x["transaction_id"]: x["txn_count_1h"] for x in anomalies.trailing_hour_count(processed, r).collect()}
    assert per_row == {x["transaction_id"]: x["c"] for x in plain.collect()}


def test_detect_anomalies_equals_union_of_rules(spark, rules):
    recs, i = [], 0
    for acc, per in (("ACC_00001", 900), ("ACC_00002", 40), ("ACC_00003", 1)):
        for k in range(per):
            recs.append(rec(i, k * 191 + (k % 4) * 7, amount=5 + (k * 37) % 9000, account=acc))
            i += 1
    recs += [rec(5000 + k, 100000 + k * 5, amount=3 + k, account="ACC_00002") for k in range(4)]
    processed = processed_of(spark, rules, recs)
    union = (anomalies.high_frequency(processed, rules)
             .unionByName(anomalies.high_daily_amount(processed, rules))
             .unionByName(anomalies.rapid_succession(processed, rules)))
    combined = anomalies.detect_anomalies(processed, rules)
    assert {r["alert_type"] for r in combined.collect()} == {"HIGH_FREQUENCY", "HIGH_DAILY_AMOUNT", "RAPID_SUCCESSION"}
    assert sorted(map(tuple, combined.collect())) == sorted(map(tuple, union.select(*combined.columns).collect()))


def test_trailing_counts_add_up_by_running_sums(spark, rules):
    """A look-back of days costs the same for every second: no frame slides over the
    account's seconds (which would be quadratic in them), and counts equal brute force."""
    import random

    r = random.Random(7)
    recs = [rec(i, r.randrange(9 * 86_400) if i % 2 else 300_000 + r.randrange(90), account=f"ACC_0000{1 + i % 3 // 2}", base=datetime(2024, 6, 1))
            for i in range(240)]
    seen: dict[str, list[int]] = {}
    for x in recs:
        seen.setdefault(x["account_id"], []).append(int((datetime.fromisoformat(x["timestamp"]) - datetime(1970, 1, 1)).total_seconds()))
    rows = processed_of(spark, rules, recs)
    for window in (60, 3_600, 86_399, 3 * 86_400):
        profile = anomalies.second_profile(rows, rules.with_(burst_window_sec=window))
        assert "specifiedwindowframe(RangeFrame, -" not in profile._jdf.queryExecution().toString()
        got = sorted((p["account_id"], p["sec"], p["n"], p["trailing_n"], p["prev_sec"]) for p in profile.collect())
        want = sorted((a, s, secs.count(s), sum(s - window <= o <= s for o in secs), max((o for o in secs if o < s), default=None))
                      for a, secs in seen.items() for s in set(secs))
        assert [g[:4] for g in got] == [w[:4] for w in want]
        # the second before is known as far as the rapid rule reaches; farther ones may lie in an earlier bucket
        close = lambda rows: [p if p and s - p < rules.rapid_gap_sec else None for _, s, _, _, p in rows]
        assert close(got) == close(want)
