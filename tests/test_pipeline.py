from conftest import base_record, uid
from settleline.plans.pipeline import read_alerts, read_settlements, run_batch
from settleline.sources.landing import from_records


def _batch(spark):
    recs = [base_record(transaction_id=uid(i), amount=30000 if i < 3 else 20,
                        timestamp=f"2024-06-0{1 + i % 3}T10:00:{i:02d}") for i in range(12)]
    recs.append(dict(recs[0]))                      # redelivery
    recs.append(base_record(transaction_id=None))  # invalid
    recs.append(base_record(transaction_id=uid(77), timestamp="garbage"))  # invalid, but has an id
    return from_records(spark, recs)


def _snapshot(spark, paths):
    out = {}
    root = paths["processed"].removesuffix("/processed")
    frames = {name: spark.read.parquet(paths[name]) for name in ("raw_transactions", "processed", "data_quality_log", "report_partials")}
    frames |= {"daily_settlements": read_settlements(spark, root), "anomaly_alerts": read_alerts(spark, root)}
    for name, df in frames.items():
        cols = [c for c in df.columns if c not in ("detection_time", "processed_at", "loaded_at")]
        out[name] = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(cols)).collect())
    return out


def test_run_batch_writes_and_is_idempotent(spark, rules, tmp_path):
    root = str(tmp_path / "warehouse")
    landing = _batch(spark)
    first = run_batch(spark, landing, root, rules, batch_id="b-1")
    assert first.report["total"] == 15 and first.report["invalid"] == 2
    assert first.report["error_breakdown"] == {"transaction_id": 1, "timestamp": 1}
    snap1 = _snapshot(spark, first.paths)
    assert len(snap1["processed"]) == 12
    assert len(snap1["data_quality_log"]) == 1
    assert spark.read.parquet(first.paths["quarantine"]).count() == 2
    assert len(snap1["raw_transactions"]) == 13  # 12 ids + the id with a bad timestamp
    import os

    from settleline.plans.pipeline import staged_batch_path
    assert not os.path.exists(staged_batch_path(spark, root, "b-1").replace("file:", ""))
    again = run_batch(spark, landing, root, rules, batch_id="b-1")
    assert _snapshot(spark, again.paths) == snap1


def test_upsert_replaces_by_key(spark, rules, tmp_path):
    root = str(tmp_path / "wh")
    recs = [base_record(transaction_id=uid(1), amount=10, timestamp="2024-06-01T10:00:00")]
    run_batch(spark, from_records(spark, recs), root, rules, batch_id="a", scope="batch")
    recs2 = [base_record(transaction_id=uid(2), amount=30, timestamp="2024-06-01T11:00:00"),
             base_record(transaction_id=uid(3), amount=5, timestamp="2024-06-02T11:00:00")]
    res = run_batch(spark, from_records(spark, recs2), root, rules, batch_id="b", scope="batch")
    s = {str(r["settlement_date"]): r for r in read_settlements(spark, root).collect()}
    # batch scope: the later batch's measures replace the stored row
    assert float(s["2024-06-01"]["total_amount"]) == 30.0
    assert float(s["2024-06-02"]["total_amount"]) == 5.0
    assert spark.read.parquet(res.paths["processed"]).count() == 3


def test_staging_falls_back_beside_tables(spark, rules, tmp_path):
    from settleline.session import checkpoint_dir

    assert checkpoint_dir(spark, fallback="unused")  # the test session names a folder
    root = str(tmp_path / "wh3")
    assert checkpoint_dir(spark, fallback=f"{root}/_staging") != f"{root}/_staging"


def test_touched_partition_range(spark, tmp_path):
    from pyspark.sql import functions as F

    from settleline.sinks import tables

    path = str(tmp_path / "parts")
    stored = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None), ("d", "2024-01-03")], "k string, d string"
    ).withColumn("d", F.col("d").cast("date"))
    stored.write.partitionBy("d").parquet(path)

    def narrowed(*batch):
        rows = spark.createDataFrame(list(batch), "k string, d string").withColumn("d", F.col("d").cast("date"))
        target = tables.read_table(spark, path, rows.schema)
        return tables.within_range(target, "d", tables.value_range(rows, "d"))

    both = narrowed(("x", "2024-01-02"), ("y", None))
    assert sorted(r["k"] for r in both.collect()) == ["b", "c"]
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-02" in plan
    assert sorted(r["k"] for r in narrowed(("x", "2024-01-01"), ("y", "2024-01-03")).collect()) == ["a", "b", "d"]
    assert [r["k"] for r in narrowed(("y", None)).collect()] == ["c"]
    assert narrowed().count() == 0


def test_unreadable_table_raises_and_stays(spark, tmp_path):
    import pytest

    from settleline.sinks import tables

    path = tmp_path / "broken"
    path.mkdir()
    (path / "part-0.parquet").write_text("not parquet")
    batch = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(Exception):
        tables.upsert(spark, batch, str(path), ["k"])
    assert (path / "part-0.parquet").read_text() == "not parquet"


def _cut(spark, rules, root, records, n):
    """Settlements and alerts after the records came as n batches."""
    for k in range(n):
        res = run_batch(spark, from_records(spark, records[k::n]), str(root), rules, batch_id=f"b{k}")
    rows = read_settlements(spark, str(root)).collect()
    alerts = read_alerts(spark, str(root)).drop("batch_id", "detection_time").collect()
    return sorted(map(str, rows)), sorted(map(str, alerts)), res


def _many_records():
    from datetime import datetime, timedelta

    t0 = datetime(2024, 6, 1, 23, 40)
    recs = [base_record(transaction_id=uid(i), account_id=f"ACC_0000{1 + i % 2}", amount=100 + i * 37 % 9000,
                        transaction_type=["REFUND", "FEE_CHARGE"][i % 2],
                        timestamp=(t0 + timedelta(seconds=i * 29 + i % 7)).isoformat()) for i in range(120)]
    recs += [base_record(transaction_id=uid(1000 + i), account_id="ACC_00003", amount=100,
                         timestamp=f"2024-06-05T10:00:{i:02d}") for i in range(20)]
    return recs


def test_tables_do_not_depend_on_the_cut(spark, rules, tmp_path):
    recs = _many_records()
    one = _cut(spark, rules, tmp_path / "one", recs, 1)
    assert {"HIGH_FREQUENCY", "RAPID_SUCCESSION", "HIGH_DAILY_AMOUNT"} == {
        a.alert_type for a in read_alerts(spark, str(tmp_path / "one")).collect()}
    for n in (2, 5):
        many = _cut(spark, rules, tmp_path / f"cut{n}", recs, n)
        assert many[:2] == one[:2]
    assert one[2].metrics["records_transformed"] == 140 and one[2].metrics["anomalies_detected"] == len(one[1])
    assert one[2].metrics["settlement_rows"] == len(one[0])


def test_stored_row_wins_across_dates(spark, rules, tmp_path):
    root = str(tmp_path / "wh")
    run_batch(spark, from_records(spark, [base_record(transaction_id=uid(1), amount=10, timestamp="2024-06-01T10:00:00")]),
              root, rules, batch_id="a")
    res = run_batch(spark, from_records(spark, [base_record(transaction_id=uid(1), amount=99, timestamp="2024-06-02T10:00:00")]),
                    root, rules, batch_id="b")
    for name in ("processed", "raw_transactions"):
        rows = spark.read.parquet(res.paths[name]).collect()
        assert [float(r["amount"]) for r in rows] == [10.0]
    assert [float(r["total_amount"]) for r in read_settlements(spark, root).collect()] == [10.0]


def test_one_now_per_batch(spark, tmp_path):
    """With default rules no row is both quarantined and processed, and none is lost."""
    from datetime import datetime, timedelta, timezone

    from settleline import Rules

    now = datetime.now(timezone.utc).replace(tzinfo=None)
    recs = [base_record(transaction_id=uid(i), timestamp=(now + timedelta(seconds=i)).isoformat()) for i in range(-5, 12)
            if i >= 0 or True]
    recs = [dict(r, transaction_id=uid(100 + k)) for k, r in enumerate(recs)]
    res = run_batch(spark, from_records(spark, recs), str(tmp_path / "now"), Rules(), batch_id="n")
    bad = spark.read.parquet(res.paths["quarantine"]).collect()
    good = spark.read.parquet(res.paths["processed"]).collect()
    assert len(bad) + len(good) == len(recs) == res.report["total"]
    assert not {r["record"]["transaction_id"] for r in bad} & {r["transaction_id"] for r in good}
    assert all(r["errors"] for r in bad) and len(good) >= 5


def test_reports_over_stored_tables(spark, rules, tmp_path):
    from settleline.operators import reports
    from settleline.plans.pipeline import run_reports

    root = tmp_path / "rep"
    _cut(spark, rules, root, _many_records(), 2)
    out = run_reports(spark, str(root), rules)
    # accounts, hours and merchants come from the per-day partials, not from the transactions
    for name in ("top_accounts", "hourly_risk", "merchant_risk"):
        files = out[name].inputFiles()
        assert any("/report_partials/" in f for f in files) and not any("/processed/" in f for f in files)
        whole = {"top_accounts": lambda p: reports.top_accounts(p, read_alerts(spark, str(root))), "hourly_risk": reports.hourly_risk,
                 "merchant_risk": reports.merchant_risk}[name](spark.read.parquet(f"{root}/processed"))
        assert out[name].collect() == whole.collect()
    assert list(out) == ["settlement_summary", "top_accounts", "hourly_risk", "merchant_risk", "account_patterns"]
    top = out["top_accounts"].collect()
    assert [r["account_id"] for r in top] == sorted((r["account_id"] for r in top), key=lambda a: (
        -next(x["total_volume"] for x in top if x["account_id"] == a), a))
    plan = out["top_accounts"]._jdf.queryExecution().executedPlan().toString()
    assert "RightOuter" not in plan


def test_staged_landing_gives_same_tables(spark, rules, tmp_path):
    a = run_batch(spark, _batch(spark), str(tmp_path / "plain"), rules, batch_id="s")
    b = run_batch(spark, _batch(spark), str(tmp_path / "staged"), rules, batch_id="s", stage_landing=True)
    assert a.report == b.report
    assert _snapshot(spark, a.paths) == _snapshot(spark, b.paths)
