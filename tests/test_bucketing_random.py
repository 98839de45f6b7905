"""Randomised exactness checks of the bucketed designs against plain whole-account windows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import base_record, uid
from settleline.operators import anomalies, enrich, reports, validate
from settleline.sources.landing import from_records

TYPES = ["REFUND", "FEE_CHARGE", "ACCOUNT_DEPOSIT"]


def random_processed(spark, rules, seed, n=1500):
    rng = random.Random(seed)
    base = datetime(2024, 3, 9, 22, 30, 0)
    recs = []
    for i in range(n):
        acc = rng.choice(["ACC_00001"] * 6 + ["ACC_00002", "ACC_00003", "ACC_00004"])
        if rng.random() < 0.3:        # bursts: many rows in the same few seconds
            sec = rng.choice([0, 1, 3599, 3600, 5400, 86399, 86400, 90000]) + rng.randint(0, 3)
        else:
            sec = rng.randint(0, 3 * 86400)
        ts = base + timedelta(seconds=sec, microseconds=rng.choice([0, 0, 500000, rng.randint(0, 999999)]))
        recs.append(base_record(transaction_id=uid(i), account_id=acc, timestamp=ts.isoformat(),
                                amount=rng.choice([1, 5, 50, 400, 3000, 9000, 40000]) + rng.randint(0, 99) / 100,
                                transaction_type=rng.choice(TYPES)))
    return enrich.processed(validate.valid_landing(from_records(spark, recs), rules), rules)


@pytest.mark.parametrize("seed", [1, 2])
def test_histogram_rules_random(spark, rules, seed):
    processed = random_processed(spark, rules, seed)
    sec = F.unix_seconds(F.to_timestamp(F.col("ts")))
    p = processed.withColumn("sec", sec)
    trailing = Window.partitionBy("account_id").orderBy("sec").rangeBetween(-3600, 0)
    ordered = Window.partitionBy("account_id").orderBy("ts", "transaction_id")
    plain = p.select("account_id", "amount", F.count(F.lit(1)).over(trailing).alias("c"),
                     (F.col("sec") - F.lag("sec").over(ordered)).alias("gap"))
    hf_plain = {r[0]: (r[1], r[2]) for r in plain.filter("c > 10").groupBy("account_id")
                .agg(F.max("c"), F.sum("amount")).collect()}
    rs_plain = {r[0]: (r[1], r[2]) for r in plain.filter("gap < 30").groupBy("account_id")
                .agg(F.count(F.lit(1)), F.sum("amount")).collect()}
    assert hf_plain and rs_plain
    for bucket in (3600, 86400):
        r = rules.with_(histogram_bucket_sec=bucket)
        alerts = anomalies.detect_anomalies(processed, r).collect()
        hf = {a["account_id"]: (a["transaction_count"], a["total_amount"]) for a in alerts
              if a["alert_type"] == "HIGH_FREQUENCY"}
        rs = {a["account_id"]: (a["transaction_count"], a["total_amount"]) for a in alerts
              if a["alert_type"] == "RAPID_SUCCESSION"}
        assert hf == hf_plain and rs == rs_plain


@pytest.mark.parametrize("seed", [3, 4])
def test_pattern_buckets_random(spark, rules, seed):
    processed = random_processed(spark, rules, seed)
    w = Window.partitionBy("account_id").orderBy("ts", "transaction_id")
    p = processed.select("account_id", "amount", "transaction_type", F.lag("amount").over(w).alias("pa"),
                         F.lead("amount").over(w).alias("na"), F.lag("transaction_type").over(w).alias("pt"))
    flags = p.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.col("transaction_type") == F.col("pt"), F.lit(False))).alias("rep"),
        F.count_if((F.col("amount") > F.coalesce("pa", F.lit(0))) & (F.coalesce("na", F.lit(0)) > F.col("amount")))
        .alias("esc"),
        F.count_if(F.coalesce(F.abs(F.col("amount") - F.col("pa")) / F.nullif(F.col("pa"), F.lit(0)) > 5,
                              F.lit(False))).alias("dev"))
    expected = {r["account_id"]: (r["n"], r["rep"], r["esc"], r["dev"]) for r in flags.collect()}
    for bucket in (1, 60, 3600):
        got = reports.account_patterns(processed, rules.with_(pattern_bucket_sec=bucket), k=100).collect()
        assert {r["account_id"]: (r["total_transactions"], r["repeated_type_count"], r["escalating_count"],
                                  r["deviation_count"]) for r in got} == {
            k: v for k, v in expected.items() if v[1] > 2 or v[2] > 1 or v[3] > 0}
