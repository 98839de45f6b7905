"""State kept up by what a batch changes: alerts, key index, committed folders."""

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import base_record, uid
from pyspark.sql import functions as F
from settleline.operators import anomalies, enrich, validate
from settleline.plans import account_state
from settleline.plans.pipeline import read_alerts, read_settlements, run_batch, table_paths
from settleline.sinks import tables
from settleline.sinks.commits import CommitLog, latest
from settleline.sinks.key_index import KeyIndex
from settleline.sources.landing import from_records

ALERT = ["account_id", "alert_type", "alert_description", "transaction_count", "total_amount", "alert_date"]


def rows_of(df, cols=ALERT):
    return sorted(tuple(map(str, r)) for r in df.select(*cols).collect())


def recomputed(spark, recs, rules):
    return anomalies.detect_anomalies(enrich.processed(validate.valid_landing(from_records(spark, recs), rules), rules), rules)


def busy_records(seed, n=160):
    rng, t0 = random.Random(seed), datetime(2024, 6, 1)
    return [base_record(transaction_id=uid(i), account_id=f"ACC_0000{rng.choice([1, 1, 2, 3])}", amount=rng.randint(1, 20000),
                        timestamp=(t0 + timedelta(seconds=rng.choice([0, 3 * 86400, 86400 - 900]) + rng.randint(0, 2400))).isoformat())
            for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("window", [3600, 2 * 86400])
def test_random_cuts_equal_recomputation(spark, rules, tmp_path, seed, window):
    rules, rng, recs = rules.with_(burst_window_sec=window), random.Random(seed), busy_records(seed)
    root, cut = str(tmp_path / "wh"), rng.randint(2, 3)
    parts = [[r for r in recs if hash((seed, r["transaction_id"])) % cut == k] for k in range(cut)]
    for k, part in enumerate(parts):
        run_batch(spark, from_records(spark, part + part[:5]), root, rules, batch_id=f"b{k}")
    want = rows_of(recomputed(spark, recs, rules))
    assert rows_of(read_alerts(spark, root)) == want and {w[1] for w in want} >= {"HIGH_FREQUENCY", "RAPID_SUCCESSION"}
    totals = account_state.stored(CommitLog(spark, table_paths(root)["anomaly_alerts"]), "totals")
    days = account_state.stored(CommitLog(spark, table_paths(root)["anomaly_alerts"]), "days")
    assert sorted(map(str, totals.select(sorted(totals.columns)).collect())) == sorted(
        map(str, anomalies.account_totals(days).select(sorted(totals.columns)).collect()))


def test_look_back_over_days_in_two_batches(spark, rules, tmp_path):
    """Five rows over three days: the alert shows however the rows come in."""
    rules = rules.with_(burst_window_sec=3 * 86400, burst_min_exclusive=3)
    recs = [base_record(transaction_id=uid(i), amount=5, timestamp=f"2024-06-0{1 + i // 2}T10:00:0{i}") for i in range(5)]
    want = rows_of(recomputed(spark, recs, rules))
    assert any(w[1] == "HIGH_FREQUENCY" and w[3] == "5" for w in want)
    for order in (recs, recs[::-1]):
        root = str(tmp_path / f"wh{order[0]['transaction_id'][-1]}")
        for k in (0, 1):
            run_batch(spark, from_records(spark, order[:3] if k == 0 else order[3:]), root, rules, batch_id=f"b{k}")
        assert rows_of(read_alerts(spark, root)) == want


def test_a_batch_writes_what_it_touches_alone(spark, rules, tmp_path):
    root, t0 = str(tmp_path / "wh"), datetime(2024, 6, 1, 10)
    recs = [base_record(transaction_id=uid(100 * a + i), account_id=f"ACC_0000{a}", amount=10 + i, timestamp=(t0 + timedelta(days=a, seconds=i)).isoformat())
            for a in range(1, 6) for i in range(15)]
    run_batch(spark, from_records(spark, recs), root, rules, batch_id="first")
    before = {r["alert_id"]: r for r in read_alerts(spark, root).collect()}
    assert len(before) == 10  # two kinds for each of five accounts
    log = CommitLog(spark, table_paths(root)["anomaly_alerts"])
    extra = [base_record(transaction_id=uid(9000), account_id="ACC_00003", amount=7, timestamp=(t0 + timedelta(days=3, seconds=20)).isoformat())]
    res = run_batch(spark, from_records(spark, extra), root, rules, batch_id="second")
    new = log.current()[-1]
    written = {part: spark.read.parquet(log.folder(new.folder, part)).collect() for part in account_state.PARTS}
    assert {r["account_id"] for rows in written.values() for r in rows} == {"ACC_00003"}
    assert [len(written[p]) for p in ("days", "totals", "alerts")] == [1, 1, 2] and res.metrics["anomalies_detected"] == 2
    after = {r["alert_id"]: r for r in read_alerts(spark, root).collect()}
    assert {i for i in after if after[i] != before[i]} == {r["alert_id"] for r in written["alerts"]}
    assert {after[r["alert_id"]]["batch_id"] for r in written["alerts"]} == {"second"}
    again = run_batch(spark, from_records(spark, extra), root, rules, batch_id="third")  # redelivered: nothing changes
    assert again.metrics["anomalies_detected"] == 0 and {r["alert_id"]: r for r in read_alerts(spark, root).collect()} == after


def test_a_stray_date_reads_its_own_days(spark, rules, tmp_path):
    """Dynamic pruning: of 40 stored dates only the two that the batch has rows on are read."""
    path = str(tmp_path / "t")
    spark.range(400).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d")).write.partitionBy("d").parquet(path)
    spark.createDataFrame([("2024-01-01",), ("2024-02-05",)], "d string").select(F.col("d").cast("date")).write.parquet(str(tmp_path / "dates"))
    own = tables.within_dates(spark.read.parquet(path).withColumnRenamed("d", "day"), "day", spark.read.parquet(str(tmp_path / "dates")))
    # the column is renamed above the scan: pruning must reach through to the partition filter
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert own.count() == 20 and sorted(own.columns) == ["day", "id"]
    scan = own._jdf.queryExecution().executedPlan()
    own.collect()
    files = [m for m in scan.toString().splitlines() if "FileScan" in m]
    assert files and all("dynamicpruning" in f for f in files if "id#" in f)


def test_changed_rules_rebuild_the_state(spark, rules, tmp_path):
    root, recs = str(tmp_path / "wh"), busy_records(5, 60)
    run_batch(spark, from_records(spark, recs[:50]), root, rules, batch_id="a")
    other = rules.with_(burst_min_exclusive=2)
    run_batch(spark, from_records(spark, recs[50:]), root, other, batch_id="b")
    assert rows_of(read_alerts(spark, root)) == rows_of(recomputed(spark, recs, other))


def test_compaction_keeps_the_state(spark, rules, tmp_path, monkeypatch):
    monkeypatch.setattr(account_state, "COMPACT_AFTER", 1)
    root, recs = str(tmp_path / "wh"), busy_records(6, 60)
    for k in range(3):
        run_batch(spark, from_records(spark, recs[k::3]), root, rules, batch_id=f"b{k}")
    log = CommitLog(spark, table_paths(root)["anomaly_alerts"])
    assert any(c.replaces for c in log.history())
    assert rows_of(read_alerts(spark, root)) == rows_of(recomputed(spark, recs, rules))


def test_failed_update_leaves_the_old_state(spark, rules, tmp_path, monkeypatch):
    root, recs = str(tmp_path / "wh"), busy_records(7, 60)
    run_batch(spark, from_records(spark, recs[:30]), root, rules, batch_id="a")
    alerts, settlements = rows_of(read_alerts(spark, root)), rows_of(read_settlements(spark, root), ["settlement_date", "total_amount", "running_total"])
    monkeypatch.setattr(CommitLog, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        run_batch(spark, from_records(spark, recs[30:]), root, rules, batch_id="b")
    assert rows_of(read_alerts(spark, root)) == alerts
    assert rows_of(read_settlements(spark, root), ["settlement_date", "total_amount", "running_total"]) == settlements
    monkeypatch.undo()
    run_batch(spark, from_records(spark, recs[30:]), root, rules, batch_id="another id")
    assert rows_of(read_alerts(spark, root)) == rows_of(recomputed(spark, recs, rules))


def test_commit_log(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.read() is None and log.current() == [] and log.next_number() == 1
    for k in range(2):
        spark.createDataFrame([(1, k, k)], "key int, v int, seq int").write.parquet(log.folder(f"f{k}"))
        log.publish(f"f{k}", note="n")
    assert [tuple(r) for r in latest(log.read(), ["key"]).collect()] == [(1, 1)]
    spark.createDataFrame([(5, 5, 5)], "key int, v int, seq int").write.parquet(log.folder("unseen"))  # never published
    assert log.read().count() == 2
    for k in range(3):  # rows that come from the table itself
        log.replace(log.read().withColumn("v", F.col("v") + 1))
    assert sorted(r["v"] for r in log.read().collect()) == [3, 4]
    assert len(log.history()) == 2 and [c.number for c in log.history()] == [4, 5]
    kept = set(os.listdir(tmp_path / "log" / "_data"))
    assert {c.folder for c in log.history()} <= kept and "f0" not in kept


def test_key_index_shuffles_the_batch_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7).alias("p"))
    tables.insert_if_absent(spark, first, path, ["key"], ["p"], indexed=True)
    batch = spark.range(1500, 2500).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(9).cast("long").alias("p"))
    index = KeyIndex(spark, path, "key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.absent(batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
    tables.insert_if_absent(spark, batch, path, ["key"], ["p"], indexed=True)
    rows = spark.read.parquet(path)
    assert rows.count() == 2500 == rows.select("key").distinct().count() and rows.where("p = 9").count() == 500


def test_key_index_follows_the_data_files(spark, tmp_path):
    """Rows that got into the table without the index (a batch that failed after its write) count as stored."""
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(10)], "key string, v int")
    rows.write.parquet(path)
    tables.insert_if_absent(spark, rows.withColumn("v", F.lit(99)), path, ["key"], indexed=True)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == list(range(10))
    spark.createDataFrame([("lost", 1)], "key string, v int").write.mode("append").parquet(path)
    assert KeyIndex(spark, path, "key").catch_up() >= 1 and KeyIndex(spark, path, "key").catch_up() == 0
    tables.insert_if_absent(spark, spark.createDataFrame([("lost", 2), ("new", 3)], "key string, v int"), path, ["key"], indexed=True)
    assert {r["key"]: r["v"] for r in spark.read.parquet(path).collect()} == {**{f"k{i}": i for i in range(10)}, "lost": 1, "new": 3}
