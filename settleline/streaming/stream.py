"""Structured Streaming twins of the batch operators.

The same validation / enrichment functions run unchanged on a streaming
DataFrame (they are stateless projections and filters).  Stateful parts use
event-time watermarks so state stays bounded:

* de-duplication: ``dropDuplicatesWithinWatermark(["transaction_id"])``;
* settlements: tumbling 1-day windows per type; running totals and
  day-over-day change are windows over the emitted table (batch side), since
  LAG over a stream is not supported;
* HIGH_DAILY_AMOUNT: tumbling 1-day windows per account;
* RAPID_SUCCESSION: session windows per account on whole-second event time
  with a gap of (rapid_gap_sec - 1) seconds — Spark merges sessions whose
  ranges touch, so a 29 s gap joins rows at most 29 s apart, i.e. exactly the
  "< 30 s" pairs.  In a session of n rows, n - 1 rows are the later row of a
  close pair, and their amount is the session sum minus its first row.
* ``foreachBatch`` sinks apply the same keyed writes as ``run_batch``, with a
  deterministic batch id per (query id, epoch), so a replayed epoch is a no-op.

Rows later than the watermark are dropped by Spark; the ``LateRows`` listener
counts them over all triggers.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import DEFAULT_RULES, HIGH_DAILY_AMOUNT, RAPID_SUCCESSION, Rules
from ..functions import alert_text
from ..functions.derive import exact_mean
from ..functions.parsing import epoch_seconds
from ..operators import enrich, validate
from ..schema import AMOUNT_TYPE, LANDING_SCHEMA, MONEY_SUM_TYPE
from ..sinks import tables

_MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def read_landing_stream(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """File-source stream of landing records with the declared schema (no inference)."""
    return spark.readStream.schema(LANDING_SCHEMA).options(**options).format(fmt).load(path)


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                      starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Unbounded topic read -> landing rows (same PERMISSIVE JSON parse as the batch reader).

    ``max_offsets_per_trigger`` bounds each micro-batch, which also bounds the rows a
    single account contributes to one state-function call.  Needs the Kafka connector.
    """
    from ..sources.landing import from_json_values

    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return from_json_values(reader.load())


def event_time(ts_ntz) -> "F.Column":
    """Event time for watermarks and windows: the whole second of a naive UTC
    TIMESTAMP_NTZ as a TIMESTAMP instant, independent of the session zone.
    Whole seconds are the granularity every time rule works at; sub-second
    order is taken from ``ts`` where it matters."""
    return F.timestamp_seconds(epoch_seconds(ts_ntz))


def quarantine_stream(landing: DataFrame, rules: Rules) -> DataFrame:
    """The rows that ``enriched_stream`` leaves out, as {record, errors}: write them beside it."""
    return validate.quarantine(validate.with_errors(landing, rules))


def enriched_stream(landing: DataFrame, rules: Rules, dedupe: bool = False,
                    watermark: str = "1 day") -> DataFrame:
    """Stateless validation + enrichment of valid rows; optional watermark de-duplication.

    Invalid rows go to ``quarantine_stream``.  Without a fixed ``rules.as_of`` the
    future-timestamp rule uses each micro-batch's own time.
    """
    rows = enrich.typed(validate.valid_landing(landing, rules)).withColumn("event_time", event_time(F.col("ts")))
    rows = rows.withWatermark("event_time", watermark)
    if dedupe:
        rows = rows.dropDuplicatesWithinWatermark(["transaction_id"])
    return enrich.enrich(rows, rules)


def utc_date(instant) -> "F.Column":
    """Calendar date (UTC) of a TIMESTAMP instant, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / F.lit(86400)).cast("int"))


def settlement_windows(enriched: DataFrame) -> DataFrame:
    """Per (1-day window, type): total, count, flagged count (no running columns)."""
    return (
        enriched.groupBy(F.window("event_time", "1 day").alias("w"), "transaction_type")
        .agg(
            F.sum("amount").alias("_sum"),
            F.count(F.lit(1)).alias("transaction_count"),
            F.count_if(F.col("is_flagged") == F.lit(True)).alias("flagged_count"),
        )
        .select(
            utc_date(F.col("w.start")).alias("settlement_date"),
            "transaction_type",
            F.col("_sum").cast(MONEY_SUM_TYPE).alias("total_amount"),
            exact_mean(F.col("_sum"), F.col("transaction_count"), 2).cast(AMOUNT_TYPE).alias("avg_amount"),
            "transaction_count",
            "flagged_count",
        )
    )


def daily_amount_windows(enriched: DataFrame, rules: Rules) -> DataFrame:
    """HIGH_DAILY_AMOUNT candidates per (account, 1-day window)."""
    days = (
        enriched.groupBy("account_id", F.window("event_time", "1 day").alias("w"))
        .agg(F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"))
        .filter(F.col("total_amount") > rules.daily_amount_limit)
    )
    return days.select(
        "account_id",
        F.lit(HIGH_DAILY_AMOUNT).alias("alert_type"),
        alert_text.high_daily_amount(F.col("total_amount"), rules).alias("alert_description"),
        F.col("transaction_count").cast("long").alias("transaction_count"),
        F.col("total_amount").cast(MONEY_SUM_TYPE).alias("total_amount"),
        utc_date(F.col("w.start")).alias("alert_date"),
    )


def rapid_sessions(enriched: DataFrame, rules: Rules) -> DataFrame:
    """Per (account, session): close-pair count and amount of the later rows.

    Append mode: a session is emitted once the watermark has passed its end.
    """
    gap = f"{rules.rapid_gap_sec - 1} seconds"
    sessions = (
        enriched.groupBy("account_id", F.session_window("event_time", gap).alias("s"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount").alias("amt"),
            F.min_by("amount", F.struct("ts", "transaction_id")).alias("first_amt"),
        )
    )
    return sessions.filter(F.col("n") > 1).select(
        "account_id",
        F.col("s.start").alias("session_start"),
        (F.col("n") - 1).alias("close_n"),
        (F.col("amt") - F.col("first_amt")).alias("close_amt"),
    )


@contextmanager
def sessions_merged_locally(spark: SparkSession):
    """Queries started inside merge an account's sessions in each task before they are dealt by
    account, so a busy account sends its sessions, not its rows, to one task; the setting comes back after."""
    before = spark.conf.get(_MERGE_SESSIONS, None)
    spark.conf.set(_MERGE_SESSIONS, "true")
    try:
        yield
    finally:
        spark.conf.unset(_MERGE_SESSIONS) if before is None else spark.conf.set(_MERGE_SESSIONS, before)


def rapid_alerts_from_sessions(sessions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Batch side: per-account RAPID_SUCCESSION alerts from emitted session rows."""
    per_account = sessions.groupBy("account_id").agg(
        F.sum("close_n").alias("transaction_count"), F.sum("close_amt").alias("total_amount")
    )
    return per_account.select(
        "account_id",
        F.lit(RAPID_SUCCESSION).alias("alert_type"),
        alert_text.rapid_succession(F.col("transaction_count"), rules).alias("alert_description"),
        F.col("transaction_count").cast("long").alias("transaction_count"),
        F.col("total_amount").cast(MONEY_SUM_TYPE).alias("total_amount"),
        F.lit(None).cast("date").alias("alert_date"),
    )


def upsert_sink(spark: SparkSession, path: str, keys: list[str], partition_by: list[str]):
    """foreachBatch function: keyed upsert of each micro-batch into a parquet table."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        # Every action on a micro-batch re-runs its (stateful) plan: it is staged once in
        # shared storage for the emptiness check and the upsert's reads and write.
        staging = tables.staging_path(spark, path)
        batch.write.parquet(staging)
        rows = spark.read.schema(batch.schema).parquet(staging)
        if not rows.isEmpty():  # e.g. the no-data batch that only advances the watermark
            tables.upsert(spark, rows, path, keys, partition_by, staged=True)
        tables.delete_path(spark, staging)

    return write


def pipeline_sink(spark: SparkSession, root: str, rules: Rules, query_name: str, scope: str = "table"):
    """foreachBatch function running the full batch pipeline on each micro-batch.

    The micro-batch is staged in the shared checkpoint folder (several jobs read it).
    With ``scope="table"`` the tables don't depend on how the stream was cut into
    micro-batches, and a replayed epoch changes nothing.
    """
    from ..plans.pipeline import run_batch

    def write(batch: DataFrame, epoch_id: int) -> None:
        staging = tables.staging_path(spark, root)
        batch.write.parquet(staging)
        rows = spark.read.schema(batch.schema).parquet(staging)
        if not rows.isEmpty():
            run_batch(spark, rows, root, rules, batch_id=f"{query_name}-{epoch_id}", scope=scope)
        tables.delete_path(spark, staging)

    return write


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators dropped for arriving behind the watermark.

    Add it to ``spark.streams`` before the queries start: it hears of every trigger
    (a query itself remembers only its latest ones).
    """

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators or [])
        self.by_query[str(p.id)] = self.by_query.get(str(p.id), 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.by_query.get(str(query.id), 0)


class ObservedBatches(StreamingQueryListener):
    """The metrics that ``DataFrame.observe(name, ...)`` takes of every trigger with rows, by
    (query id, batch id): counters of a stream without counting jobs.

    Add it to ``spark.streams`` before the query starts.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self.batches: dict[tuple[str, int], dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.observedMetrics or {}).get(self.name)
        if row is not None and p.numInputRows:
            self.batches[str(p.id), p.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, spark: SparkSession, query: StreamingQuery) -> dict[int, dict]:
        """Metrics by batch id.  Waits until the listeners have heard of all that has ended."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return {batch: m for (q, batch), m in sorted(self.batches.items()) if q == str(query.id)}


def log_stream_quality(spark: SparkSession, path: str, name: str, batches: dict[int, dict]) -> None:
    """A data-quality row for each micro-batch, from what was observed of it (see ``ObservedBatches``)."""
    for batch, metrics in batches.items():
        tables.log_quality(spark, path, f"{name}-{batch}", validate.report_from_metrics(metrics))


def run_available_now(stream: DataFrame, sink, checkpoint: str, output_mode: str = "update",
                      name: str | None = None) -> StreamingQuery:
    """Process everything available now through a foreachBatch sink, then stop."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    q = writer.foreachBatch(sink).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
