"""``run_batch``: landing -> validate -> (quarantine | dedupe -> enrich) ->
(settlements | alerts) -> keyed table writes + one data-quality row.

Job layout (each step is one Spark job; nothing but counters reaches the driver):

1. quarantine write and raw landing table (insert-if-absent by transaction_id).
   The validation counters ride along as an ``observe`` on the same scan, so the
   report costs no extra pass.
2. enriched batch -> parquet under the session's shared checkpoint folder
   (``spark.checkpoint.dir``).  This cuts the lineage once: the later steps read
   the written files, so a lost executor re-reads files instead of recomputing
   validation and de-duplication.
3. processed table: insert-if-absent on transaction_id (looked up in the table's
   bucketed key index), partitioned by transaction_date.
4. settlement totals and report partials of exactly the touched dates, again from the
   processed table; the running columns over the (dates x types) totals replace the
   settlements in one step.
5. alerts by what the batch changes (``account_state``).
6. quality log row.

With ``scope="batch"`` 4 is an upsert on (settlement_date, transaction_type) and 5 an
append with a deterministic id, both from the batch alone.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_RULES, Rules
from ..functions.parsing import parse_timestamp
from ..operators import anomalies, enrich, reports, settle, validate
from ..session import checkpoint_dir
from ..sinks import tables
from ..sinks.commits import CommitLog
from . import account_state


@dataclass
class BatchResult:
    batch_id: str
    report: dict
    metrics: dict = field(default_factory=dict)
    paths: dict = field(default_factory=dict)


def table_paths(root: str) -> dict:
    root = root.rstrip("/")
    return {
        name: f"{root}/{name}"
        for name in ("raw_transactions", "processed", "daily_settlements", "anomaly_alerts", "quarantine",
                     "data_quality_log", "settlement_totals", "report_partials")
    }


def staged_batch_path(spark: SparkSession, root: str, batch_id: str, part: str = "enriched") -> str:
    base = checkpoint_dir(spark, fallback=f"{root.rstrip('/')}/_staging")
    return f"{base.rstrip('/')}/settleline-batches/{batch_id}/{part}"


def stage_enriched(spark: SparkSession, landing: DataFrame, rules: Rules, batch_id: str,
                   root: str) -> tuple[DataFrame, int]:
    """Write the batch's enriched rows once to the shared checkpoint folder (or, when the
    session names none, a staging folder beside the tables); read back, and their number."""
    path = staged_batch_path(spark, root, batch_id)
    enriched = enrich.processed(validate.valid_landing(landing, rules), rules)
    counter = Observation("enriched")
    enriched.observe(counter, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return spark.read.schema(enriched.schema).parquet(path), counter.get["n"]


def run_batch(spark: SparkSession, landing: DataFrame, root: str, rules: Rules = DEFAULT_RULES,
              batch_id: str | None = None, persist_landing: bool = False,
              stage_landing: bool = False, scope: str = "table") -> BatchResult:
    """Process one landing batch into the tables under ``root`` (any Hadoop-FS URI).

    ``scope="table"``: settlements and alerts cover all stored transactions, so they
    don't depend on how the input was cut into batches.  ``scope="batch"``: they cover
    the batch alone, and replace or add to those of earlier ones.

    The landing frame is read by three jobs (quarantine, raw table, enriched
    batch).  Columnar sources are simply re-read.  For sources that are costly
    to re-read:
    * ``stage_landing`` writes the landing once as parquet under the shared
      checkpoint folder and runs the three jobs from that copy (text sources
      such as JSON lines or a topic: parsed once instead of three times);
    * ``persist_landing`` caches it instead (bounded inputs such as streaming
      micro-batches).
    """
    if scope not in ("table", "batch"):
        raise ValueError(f"scope must be 'table' or 'batch', not {scope!r}")
    started = time.perf_counter()
    rules = rules.frozen()  # one "now" for all the queries below
    batch_id = batch_id or str(uuid.uuid4())
    paths = table_paths(root)
    staged_landing = None
    if stage_landing:
        staged_landing = staged_batch_path(spark, root, batch_id, part="landing")
        landing.write.mode("overwrite").parquet(staged_landing)
        landing = spark.read.parquet(staged_landing)
    if persist_landing:
        landing = landing.persist()
    try:
        return _run(spark, landing, rules, batch_id, paths, root, started, scope)
    finally:
        if persist_landing:
            landing.unpersist()
        if staged_landing:
            tables.delete_path(spark, staged_landing)


def _run(spark: SparkSession, landing: DataFrame, rules: Rules, batch_id: str, paths: dict, root: str,
         started: float, scope: str) -> BatchResult:

    # 1. quarantine + validation counters in one pass
    obs = Observation("validation")
    checked = validate.with_errors(landing.observe(obs, *validate.report_columns(rules)), rules)
    validate.quarantine(checked).write.mode("overwrite").parquet(f"{paths['quarantine']}/batch_id={batch_id}")
    report = validate.report_from_metrics(obs.get)

    # 1b. raw landing table: every record with an id, insert-if-absent by the id alone
    raw = tables.raw_landing_rows(landing).select(
        "*",
        F.current_timestamp().alias("loaded_at"),
        F.to_date(parse_timestamp(F.col("timestamp"))).alias("landing_date"),
    )
    tables.insert_if_absent(spark, raw, paths["raw_transactions"], keys=["transaction_id"], partition_by=["landing_date"], indexed=True)

    # 2. enriched batch, lineage cut
    batch, transformed = stage_enriched(spark, landing, rules, batch_id, root)

    # 3. processed table; without batch de-duplication the key still has to be unique
    rows = batch if rules.dedupe else enrich.first_delivery(batch)
    tables.insert_if_absent(spark, rows, paths["processed"], keys=["transaction_id"], partition_by=["transaction_date"], indexed=True)

    # 4, 5. settlements and alerts
    counts = {"records_transformed": transformed, "settlement_rows": 0, "anomalies_detected": 0}
    if scope == "batch":
        counts |= _batch_scope(spark, batch, rules, batch_id, paths)
    elif transformed:
        counts |= _table_scope(spark, batch, rules, batch_id, paths, root)

    # 6. quality log
    tables.log_quality(spark, paths["data_quality_log"], batch_id, report)

    # the staged batch has been consumed by every write above
    tables.delete_path(spark, staged_batch_path(spark, root, batch_id))

    metrics = {
        "records_read": report["total"],
        "records_valid": report["valid"],
        **counts,
        "processing_time_sec": round(time.perf_counter() - started, 2),
    }
    return BatchResult(batch_id=batch_id, report=report, metrics=metrics, paths=paths)


def _table_scope(spark: SparkSession, batch: DataFrame, rules: Rules, batch_id: str, paths: dict, root: str) -> dict:
    """Settlements and alerts of all that is stored, whatever batches it came in.

    The settlement totals and report partials of the dates that the batch has rows on
    (those dates alone) are worked out again from the processed table; alerts follow
    from the accounts and days that the batch can have changed.
    """
    part = staged_batch_path(spark, root, batch_id, part="touched")
    batch.select(F.col("transaction_date").alias("d")).distinct().write.mode("overwrite").parquet(f"{part}/dates")
    batch.select("account_id").distinct().write.mode("overwrite").parquet(f"{part}/accounts")
    dates, accounts = spark.read.parquet(f"{part}/dates"), spark.read.parquet(f"{part}/accounts")
    processed = tables.read_table(spark, paths["processed"], batch.schema)
    touched = tables.within_dates(processed, "transaction_date", dates)

    counter = Observation("settlements")
    totals = settle.daily_totals(touched)
    tables.replace_rows(spark, totals.observe(counter, F.count(F.lit(1)).alias("n")), paths["settlement_totals"], ["settlement_date"])
    CommitLog(spark, paths["daily_settlements"]).replace(settle.with_running_columns(
        tables.read_table(spark, paths["settlement_totals"], totals.schema)))
    tables.replace_rows(spark, reports.partials(touched), paths["report_partials"], ["transaction_date"])

    raised = account_state.update(spark, paths["anomaly_alerts"], processed, accounts, dates, rules, batch_id)
    tables.delete_path(spark, part)
    return {"settlement_rows": counter.get["n"], "anomalies_detected": raised}


def _batch_scope(spark: SparkSession, batch: DataFrame, rules: Rules, batch_id: str, paths: dict) -> dict:
    """Settlements and alerts of the batch alone: a later batch's totals replace the
    stored ones of the same date and type, alerts are appended."""
    counters = {name: Observation(name) for name in ("settlements", "alerts")}
    n = F.count(F.lit(1)).alias("n")
    settlements = settle.daily_settlements(batch).observe(counters["settlements"], n)
    tables.upsert(spark, settlements, paths["daily_settlements"], keys=["settlement_date", "transaction_type"],
                  partition_by=["settlement_date"])
    alerts = anomalies.detect_anomalies(batch, rules).observe(counters["alerts"], n)
    tables.append_alerts(spark, alerts, paths["anomaly_alerts"], batch_id)
    return {"settlement_rows": counters["settlements"].get["n"], "anomalies_detected": counters["alerts"].get["n"]}


def read_settlements(spark: SparkSession, root: str) -> DataFrame:
    """The settlement table under ``root``, of either scope."""
    path = table_paths(root)["daily_settlements"]
    rows = CommitLog(spark, path).read()
    return spark.read.parquet(path) if rows is None else rows


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The alerts that stand under ``root``, of either scope."""
    path = table_paths(root)["anomaly_alerts"]
    return account_state.alerts(spark, path) if CommitLog(spark, path).current() else spark.read.parquet(path)


def run_reports(spark: SparkSession, root: str, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The five standing reports over the tables under ``root``.

    Where the per-day partials are there (table scope), accounts, hours and merchants are
    summed from them and the transactions are read for the account patterns alone.
    """
    paths = table_paths(root)
    processed = tables.read_table(spark, paths["processed"])
    if processed is None:
        raise FileNotFoundError(f"no processed table under {root}")
    partials = tables.read_table(spark, paths["report_partials"])
    if partials is None:
        partials = reports.partials(processed)
    return {
        "settlement_summary": reports.settlement_summary(read_settlements(spark, root)),
        "top_accounts": reports.top_accounts_of(reports.account_part(partials), read_alerts(spark, root)),
        "hourly_risk": reports.hourly_risk_of(reports.hour_part(partials)),
        "merchant_risk": reports.merchant_risk_of(reports.merchant_part(partials)),
        "account_patterns": reports.account_patterns(processed, rules),
    }
