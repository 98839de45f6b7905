"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them start from the driver's ``events`` table through the landing
fixture view, so their work grows with the table; nothing is sampled or capped
except where a LIMIT is the feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleline.api import process_batch
from settleline.config import Rules
from settleline.operators import anomalies, enrich, reports, settle, validate
from settleline.plans.pipeline import read_alerts, read_settlements, run_batch, run_reports, table_paths
from settleline.schema import ALERT_COLUMNS, LANDING_FIELDS
from settleline.sinks import tables
from settleline.sources import landing
from settleline.streaming import account_state, keyed_alerts
from settleline.streaming import stream as st

from . import fixture_streams as fs
from .fixture import FIXTURE_AS_OF, read_landing_fixture

FIXTURE_RULES = Rules(as_of=FIXTURE_AS_OF)
LANDING_COLS = (*LANDING_FIELDS, "is_flagged")


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing_fixture(spark, sf_dir)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.with_errors(_landing(spark, sf_dir), FIXTURE_RULES)


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.processed(validate.valid_landing(_landing(spark, sf_dir), FIXTURE_RULES), FIXTURE_RULES)


def _settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle.daily_settlements(_processed(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.detect_anomalies(_processed(spark, sf_dir), FIXTURE_RULES)


# Validation ------------------------------------------------------------------
def q_validate_rows(spark, sf_dir):
    return _checked(spark, sf_dir).select(
        *LANDING_COLS,
        "is_valid",
        F.size("errors").alias("error_count"),
        F.array_join("errors", "; ").alias("error_text"),
    )


def q_quarantine(spark, sf_dir):
    q = validate.quarantine(_checked(spark, sf_dir))
    return q.select("record.*", F.array_join("errors", "; ").alias("error_text"))


def q_validation_report(spark, sf_dir):
    return validate.report(_landing(spark, sf_dir), FIXTURE_RULES).drop("error_breakdown")


def q_error_breakdown(spark, sf_dir):
    return validate.error_breakdown(_landing(spark, sf_dir), FIXTURE_RULES)


# De-duplication, parsing round trip, enrichment ------------------------------
def q_dedupe_first(spark, sf_dir):
    valid = validate.valid_landing(_landing(spark, sf_dir), FIXTURE_RULES)
    return enrich.first_delivery(enrich.typed(valid))


def q_json_roundtrip(spark, sf_dir):
    encoded = landing.to_json_values(_landing(spark, sf_dir))
    return landing.from_json_values(encoded).select(*LANDING_COLS)


def q_enrich(spark, sf_dir):
    return _processed(spark, sf_dir).select(
        "transaction_id", "account_id", "amount", "ts", "transaction_date", "transaction_hour",
        "amount_bucket", "is_suspicious",
    )


def q_risk_score(spark, sf_dir):
    return _processed(spark, sf_dir).select("transaction_id", "risk_score")


# Settlements, windows, anomalies ---------------------------------------------
def q_daily_settlements(spark, sf_dir):
    return _settlements(spark, sf_dir)


def q_trailing_hour_count(spark, sf_dir):
    return anomalies.trailing_hour_count(_processed(spark, sf_dir), FIXTURE_RULES)


def q_anomaly_high_frequency(spark, sf_dir):
    return anomalies.high_frequency(_processed(spark, sf_dir), FIXTURE_RULES)


def q_anomaly_high_daily_amount(spark, sf_dir):
    return anomalies.high_daily_amount(_processed(spark, sf_dir), FIXTURE_RULES)


def q_anomaly_rapid_succession(spark, sf_dir):
    return anomalies.rapid_succession(_processed(spark, sf_dir), FIXTURE_RULES)


def q_anomaly_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


# Reports ----------------------------------------------------------------------
def q_rpt_settlement_summary(spark, sf_dir):
    return reports.settlement_summary(_settlements(spark, sf_dir))


def q_rpt_top_accounts(spark, sf_dir):
    processed = _processed(spark, sf_dir)
    return reports.top_accounts(processed, anomalies.detect_anomalies(processed, FIXTURE_RULES))


def q_rpt_hourly_risk(spark, sf_dir):
    return reports.hourly_risk(_processed(spark, sf_dir))


def q_rpt_merchant_risk(spark, sf_dir):
    return reports.merchant_risk(_processed(spark, sf_dir))


def q_rpt_account_patterns(spark, sf_dir):
    return reports.account_patterns(_processed(spark, sf_dir), FIXTURE_RULES)


# Keyed table writes as pure merges ------------------------------------------
FIRST_LOAD_UNTIL = "2024-01-20"   # the earlier batch covers days before this date
SECOND_LOAD_FROM = "2024-01-10"   # the later batch re-covers days from this date


def q_insert_if_absent(spark, sf_dir):
    """Raw landing table after two overlapping batches through the writer.

    The second batch redelivers ids of the first with another location and a later
    date, besides ids of its own: the stored row wins.
    """
    path = f"{fs.run_dir(spark, 'insert')}/raw"
    for rows in _two_loads(spark, sf_dir):
        tables.insert_if_absent(spark, rows, path, ["transaction_id"], ["landing_day"])
    return spark.read.parquet(path).select(*LANDING_COLS)


def _two_loads(spark, sf_dir):
    """The two overlapping raw batches of ``insert_if_absent``."""
    first = _landing(spark, sf_dir).where(F.col("timestamp") < FIRST_LOAD_UNTIL)
    second = _landing(spark, sf_dir).where(F.col("timestamp") >= SECOND_LOAD_FROM).withColumns({
        "location": F.lit("Redelivered"), "timestamp": F.concat(F.lit("2024-12-31"), F.substring("timestamp", 11, 99))})
    return [tables.raw_landing_rows(b).select("*", F.substring("timestamp", 1, 10).alias("landing_day")) for b in (first, second)]


def q_insert_if_absent_indexed(spark, sf_dir):
    """The same two batches with the keys looked up in the bucketed index."""
    path = f"{fs.run_dir(spark, 'insert-indexed')}/raw"
    for rows in _two_loads(spark, sf_dir):
        tables.insert_if_absent(spark, rows, path, ["transaction_id"], ["landing_day"], indexed=True)
    return spark.read.parquet(path).select(*LANDING_COLS)


def q_upsert_settlements(spark, sf_dir):
    """Settlement table after an earlier batch, then an overlapping later batch (upsert)."""
    processed = _processed(spark, sf_dir)
    earlier = settle.daily_settlements(processed.filter(F.col("transaction_date") < F.lit(FIRST_LOAD_UNTIL).cast("date")))
    later = settle.daily_settlements(processed.filter(F.col("transaction_date") >= F.lit(SECOND_LOAD_FROM).cast("date")))
    return tables.merged_upsert(earlier, later, ["settlement_date", "transaction_type"])


# The whole pipeline into tables ------------------------------------------------
_WAREHOUSES: dict[tuple[str, str], str] = {}


def _warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Tables of the landing records loaded as two batches (split by id); loaded once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        root = fs.run_dir(spark, "two-batches")
        half = F.crc32(F.coalesce("transaction_id", F.lit(""))) % 2
        for k in (0, 1):
            run_batch(spark, _landing(spark, sf_dir).where(half == k), root, FIXTURE_RULES, batch_id=f"half-{k}")
        _WAREHOUSES[key] = root
    return _WAREHOUSES[key]


def q_pipeline_two_batches(spark, sf_dir):
    """Settlements after two batches: those of one batch with all rows."""
    return read_settlements(spark, _warehouse(spark, sf_dir))


def q_pipeline_two_batches_alerts(spark, sf_dir):
    return read_alerts(spark, _warehouse(spark, sf_dir)).select(*ALERT_COLUMNS)


#: A look-back over several days, so the days around a batch's dates matter.
LONG_RULES = FIXTURE_RULES.with_(burst_window_sec=3 * 86_400, burst_min_exclusive=4)


def q_pipeline_long_window_alerts(spark, sf_dir):
    """Alerts after two batches under a look-back of three days."""
    root = fs.run_dir(spark, "long-window")
    half = F.crc32(F.coalesce("transaction_id", F.lit(""))) % 2
    for k in (0, 1):
        run_batch(spark, _landing(spark, sf_dir).where(half == k), root, LONG_RULES, batch_id=f"half-{k}")
    return read_alerts(spark, root).select(*ALERT_COLUMNS)


def q_quality_log(spark, sf_dir):
    """The data-quality rows of the two batches, added up."""
    log = spark.read.parquet(table_paths(_warehouse(spark, sf_dir))["data_quality_log"])
    return log.agg(*[F.sum(f"{c}_records").alias(c) for c in ("total", "valid", "invalid")])


def q_snapshots(spark, sf_dir):
    """The processed snapshot of ``process_batch`` over JSON lines on disk (source chosen by path)."""
    base = fs.run_dir(spark, "snapshots")
    landing.to_json_values(_landing(spark, sf_dir)).write.text(f"{base}/in")
    process_batch(spark, rules=FIXTURE_RULES, output_path=f"{base}/out", path=f"{base}/in")
    return spark.read.parquet(f"{base}/out/processed").select("transaction_id", "account_id", "amount", "ts", "transaction_date", "risk_score")


def q_snapshot_settlements(spark, sf_dir):
    """The settlement snapshot of ``process_batch``."""
    base = fs.run_dir(spark, "snapshot-settlements")
    process_batch(spark, _landing(spark, sf_dir), FIXTURE_RULES, f"{base}/out")
    return spark.read.parquet(f"{base}/out/settlements")


def q_quarantine_corrupt(spark, sf_dir):
    """Quarantine of a topic in which every record whose id ends in 3 is cut off: its text is kept."""
    values = landing.to_json_values(_landing(spark, sf_dir))
    cut = F.col("value").rlike(r'^\{"transaction_id":"[^"]*3"')
    broken = values.select(F.when(cut, F.expr("left(value, length(value) - 7)")).otherwise(F.col("value")).alias("value"))
    q = validate.quarantine(validate.with_errors(landing.from_json_values(broken, keep_corrupt=True), FIXTURE_RULES))
    return q.select("record.*", F.array_join("errors", "; ").alias("error_text"), "raw_text")


def placed(df: DataFrame) -> DataFrame:
    """A sorted frame with every row's place in it."""
    return df.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "place", F.row_number().over(Window.orderBy("_id"))).drop("_id")  # a report's rows: dates x types at most


def q_ordered_settlements(spark, sf_dir):
    return placed(settle.daily_settlements(_processed(spark, sf_dir), ordered=True)).select("settlement_date", "transaction_type", "place")


def q_ordered_settlement_summary(spark, sf_dir):
    return placed(reports.settlement_summary(_settlements(spark, sf_dir))).select("settlement_date", "transaction_type", "place")


def q_ordered_hourly_risk(spark, sf_dir):
    return placed(reports.hourly_risk(_processed(spark, sf_dir))).select("transaction_hour", "place")


def q_ordered_top_accounts(spark, sf_dir):
    processed = _processed(spark, sf_dir)
    return placed(reports.top_accounts(processed, anomalies.detect_anomalies(processed, FIXTURE_RULES))).select("account_id", "place")


def _stored_report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: run_reports(spark, _warehouse(spark, sf_dir), FIXTURE_RULES)[name]


# Opt-in rules and forms ----------------------------------------------------------
def q_burst_flag(spark, sf_dir):
    return enrich.with_burst_flag(_processed(spark, sf_dir), FIXTURE_RULES).select("transaction_id", "is_suspicious")


def q_validation_report_json(spark, sf_dir):
    """The report with its error_breakdown map as JSON text, keys in order."""
    report = validate.report(_landing(spark, sf_dir), FIXTURE_RULES)
    entries = F.array_sort(F.map_entries("error_breakdown"))
    parts = F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"].cast("string")))
    return report.select("total", "valid", "invalid", F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("breakdown"))


# Streaming twins (drained with availableNow over several files, compared with the batch oracle) --
def _enriched(dedupe: bool = True) -> Callable[[DataFrame], DataFrame]:
    return lambda landing_rows: st.enriched_stream(landing_rows, FIXTURE_RULES, dedupe=dedupe)


def q_stream_dedupe(spark, sf_dir):
    out = fs.drain_append(spark, sf_dir, "dedupe", lambda rows: _enriched()(rows).select(*LANDING_COLS, "ts"))
    return out.select(*LANDING_COLS, "ts")


def q_stream_quarantine(spark, sf_dir):
    q = fs.drain_append(spark, sf_dir, "quarantine", lambda rows: st.quarantine_stream(rows, FIXTURE_RULES))
    return q.select("record.*", F.array_join("errors", "; ").alias("error_text"))


def q_stream_settlements(spark, sf_dir):
    table = fs.drain_upsert(spark, sf_dir, "settlements", lambda rows: st.settlement_windows(_enriched()(rows)),
                            ["settlement_date", "transaction_type"], ["settlement_date"])
    return settle.with_running_columns(table.select(
        "settlement_date", "transaction_type", "total_amount", "avg_amount", "transaction_count", "flagged_count"))


def q_stream_daily_amount(spark, sf_dir):
    table = fs.drain_upsert(spark, sf_dir, "daily_amount",
                            lambda rows: st.daily_amount_windows(_enriched()(rows), FIXTURE_RULES),
                            ["account_id", "alert_date"], ["alert_date"])
    return table.select("account_id", "alert_type", "alert_description", "transaction_count", "total_amount",
                        "alert_date")


def q_stream_account_alerts(spark, sf_dir):
    table = fs.drain_upsert(spark, sf_dir, "account_seconds", lambda rows: account_state.account_seconds(_enriched()(rows)),
                            account_state.SECOND_KEYS, account_state.SECOND_PARTITION)
    return account_state.alerts_from_seconds(table, FIXTURE_RULES)


def q_stream_rapid_sessions(spark, sf_dir):
    """RAPID_SUCCESSION alerts from session windows in append mode."""
    with st.sessions_merged_locally(spark):
        sessions = fs.drain_append(spark, sf_dir, "sessions", lambda rows: st.rapid_sessions(_enriched()(rows), FIXTURE_RULES), flush=True)
    return st.rapid_alerts_from_sessions(sessions, FIXTURE_RULES)


def q_stream_keyed_alerts(spark, sf_dir):
    """HIGH_FREQUENCY alerts from keyed state (a map of seconds per account and bucket)."""
    with keyed_alerts.rocksdb_state(spark):
        table = fs.drain_upsert(spark, sf_dir, "keyed", lambda rows: keyed_alerts.burst_buckets(_enriched()(rows), FIXTURE_RULES),
                                keyed_alerts.BUCKET_KEYS, keyed_alerts.BUCKET_PARTITION)
    return keyed_alerts.alerts_from_buckets(table, FIXTURE_RULES)


def q_stream_hopping_frequency(spark, sf_dir):
    """Accounts over the limit in windows of one hour that start every five minutes (coarser than HIGH_FREQUENCY)."""
    out = fs.drain_append(spark, sf_dir, "hopping", lambda rows: keyed_alerts.hopping_frequency(_enriched()(rows), FIXTURE_RULES), flush=True)
    return out.select("account_id", "window_start", "window_end", "transaction_count", "total_amount")


def q_stream_burst_flag(spark, sf_dir):
    out = fs.drain_append(spark, sf_dir, "burst", lambda rows: keyed_alerts.burst_flags(_enriched()(rows)), flush=True)
    return out.select("transaction_id", "is_suspicious")


def q_stream_late_rows(spark, sf_dir):
    """Every valid row of a stream with stragglers: on time (no lateness) or in the side output."""
    on_time, behind = fs.drain_split(spark, sf_dir, "late", lambda rows: _enriched(False)(rows).select(
        "transaction_id", "account_id", "event_time", "amount"))
    return on_time.select("transaction_id", "amount", F.lit(None).cast("long").alias("late_by_sec")).unionByName(
        behind.select("transaction_id", "amount", "late_by_sec"))


def q_stream_quality_log(spark, sf_dir):
    """Quality log of a stream, from metrics observed on the way (no counting job)."""
    base, name = fs.run_dir(spark, "quality"), "validation"
    heard = st.ObservedBatches(name)
    spark.streams.addListener(heard)
    try:
        rows = fs.landing_stream(spark, sf_dir, base).observe(name, *validate.report_columns(FIXTURE_RULES))
        q = st.run_available_now(st.quarantine_stream(rows, FIXTURE_RULES), fs.epochs_into(f"{base}/table"), f"{base}/checkpoint", "append")
        st.log_stream_quality(spark, f"{base}/log", "quality", heard.of(spark, q))
    finally:
        spark.streams.removeListener(heard)
    log = spark.read.parquet(f"{base}/log")
    return log.agg(*[F.sum(f"{c}_records").alias(c) for c in ("total", "valid", "invalid")])


def q_stream_pipeline(spark, sf_dir):
    """Settlements after the landing records came as a stream of several files."""
    return read_settlements(spark, fs.drain_pipeline(spark, sf_dir, "pipeline", FIXTURE_RULES))


def reported(df: DataFrame) -> DataFrame:
    """Presentation of a query result: exact DECIMAL money/score columns are handed
    out as DOUBLE (the nearest double of the exact value, identical in every engine
    and client), so result comparison does not depend on how a client library
    converts decimals.  The operators themselves return DECIMAL."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _reporting(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reported(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


_QUERY_FUNCTIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "validate_rows": q_validate_rows,
    "validation_report": q_validation_report,
    "error_breakdown": q_error_breakdown,
    "quarantine": q_quarantine,
    "dedupe_first": q_dedupe_first,
    "json_roundtrip": q_json_roundtrip,
    "enrich": q_enrich,
    "risk_score": q_risk_score,
    "daily_settlements": q_daily_settlements,
    "trailing_hour_count": q_trailing_hour_count,
    "anomaly_high_frequency": q_anomaly_high_frequency,
    "anomaly_high_daily_amount": q_anomaly_high_daily_amount,
    "anomaly_rapid_succession": q_anomaly_rapid_succession,
    "anomaly_alerts": q_anomaly_alerts,
    "rpt_settlement_summary": q_rpt_settlement_summary,
    "rpt_top_accounts": q_rpt_top_accounts,
    "rpt_hourly_risk": q_rpt_hourly_risk,
    "rpt_merchant_risk": q_rpt_merchant_risk,
    "rpt_account_patterns": q_rpt_account_patterns,
    "insert_if_absent": q_insert_if_absent,
    "insert_if_absent_indexed": q_insert_if_absent_indexed,
    "upsert_settlements": q_upsert_settlements,
    "pipeline_two_batches": q_pipeline_two_batches,
    "pipeline_two_batches_alerts": q_pipeline_two_batches_alerts,
    "stored_settlement_summary": _stored_report("settlement_summary"),
    "stored_top_accounts": _stored_report("top_accounts"),
    "stored_hourly_risk": _stored_report("hourly_risk"),
    "stored_merchant_risk": _stored_report("merchant_risk"),
    "stored_account_patterns": _stored_report("account_patterns"),
    "pipeline_long_window_alerts": q_pipeline_long_window_alerts,
    "quality_log": q_quality_log,
    "snapshots": q_snapshots,
    "snapshot_settlements": q_snapshot_settlements,
    "quarantine_corrupt": q_quarantine_corrupt,
    "ordered_settlements": q_ordered_settlements,
    "ordered_settlement_summary": q_ordered_settlement_summary,
    "ordered_hourly_risk": q_ordered_hourly_risk,
    "ordered_top_accounts": q_ordered_top_accounts,
    "burst_flag": q_burst_flag,
    "validation_report_json": q_validation_report_json,
    "stream_dedupe": q_stream_dedupe,
    "stream_quarantine": q_stream_quarantine,
    "stream_settlements": q_stream_settlements,
    "stream_daily_amount": q_stream_daily_amount,
    "stream_account_alerts": q_stream_account_alerts,
    "stream_rapid_sessions": q_stream_rapid_sessions,
    "stream_keyed_alerts": q_stream_keyed_alerts,
    "stream_hopping_frequency": q_stream_hopping_frequency,
    "stream_burst_flag": q_stream_burst_flag,
    "stream_late_rows": q_stream_late_rows,
    "stream_quality_log": q_stream_quality_log,
    "stream_pipeline": q_stream_pipeline,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _reporting(fn) for name, fn in _QUERY_FUNCTIONS.items()
}
