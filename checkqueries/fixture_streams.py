"""Streaming runs over the driver's ``events`` table (file source), used by the
registered ``stream_*`` queries: the landing view is applied to the stream, the
stream is drained with an availableNow trigger into keyed parquet tables under
the session's checkpoint folder, and the resulting table is returned."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settleline.config import Rules
from settleline.session import checkpoint_dir, configured_checkpoint_dir, ensure_checkpoint_dir
from settleline.sinks import tables
from settleline.streaming import late
from settleline.streaming import stream as st

from .fixture import LANDING_VIEW_SQL

#: Parts, and so micro-batches, that the events are streamed as, and files of a part:
#: at least FILES, more where a file would have over FILE_ROWS rows (each is read by a task of its own).
PARTS = 3
FILES = 4
FILE_ROWS = 100_000
#: Edges of the parts of ``late_events``; every 97th earlier event comes with the last part.
LATE_EDGES = ("2024-01-11", "2024-01-21")
LATE_EVERY, LATE_REST = 97, 5


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the session's shared checkpoint folder (a local session gets one if it has none)."""
    if configured_checkpoint_dir(spark) is None and spark.sparkContext.master.startswith("local["):
        ensure_checkpoint_dir(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/settleline-streams/{name}-{uuid.uuid4().hex}"


def events_stream(spark: SparkSession, sf_dir: str, base: str, flush: bool = False) -> DataFrame:
    """All events as a stream of PARTS parts in the order of time, a part (FILES files) per micro-batch.

    ``flush`` adds a last part with one event two days later: it moves the watermark
    past all others, so append mode hands out their windows (but not its own).
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    lo, hi, rows = events.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    files = files_of_part(rows, PARTS)
    for k in range(PARTS):  # written one after the other: the file source goes by age
        part = events
        if lo is not None:
            edge = lambda i: F.lit(lo) + F.lit((hi - lo) * i / PARTS)
            first = F.col("ts").isNull() if k == 0 else F.lit(False)
            until = (F.col("ts") < edge(k + 1)) if k < PARTS - 1 else F.lit(True)
            part = events.where(first | ((F.col("ts") >= edge(k)) & until))
        part.repartition(files).write.parquet(f"{base}/in/part{k}")
    if flush and lo is not None:
        last = events.where(F.col("ts") == F.lit(hi)).orderBy("event_id").limit(1)
        last.select(F.lit(1_000_000_001).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"),
                    "user_id", "event_type", F.lit(1.0).alias("value")).write.parquet(f"{base}/in/part{PARTS}")
    return _parts(spark, events, base, files)


def files_of_part(rows: int, parts: int) -> int:
    return max(FILES, -(-rows // (parts * FILE_ROWS)))


def _parts(spark: SparkSession, events: DataFrame, base: str, files: int) -> DataFrame:
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in/*")


def late_events(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """All events as parts cut at LATE_EDGES, some of the earlier ones arriving with the last part."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    day = F.date_format("ts", "yyyy-MM-dd")
    straggler = (F.col("event_id") % LATE_EVERY == LATE_REST) & F.coalesce(day < LATE_EDGES[-1], F.lit(False))
    part = F.when(straggler, len(LATE_EDGES)).otherwise(sum((F.coalesce(day >= e, F.lit(False)).cast("int") for e in LATE_EDGES), F.lit(0)))
    files = files_of_part(events.count(), len(LATE_EDGES) + 1)
    for k in range(len(LATE_EDGES) + 1):
        events.where(part == k).repartition(files).write.parquet(f"{base}/in/part{k}")
    return _parts(spark, events, base, files)


def landing_stream(spark: SparkSession, sf_dir: str, base: str, flush: bool = False) -> DataFrame:
    return spark.sql(LANDING_VIEW_SQL, events=events_stream(spark, sf_dir, base, flush))


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table that a stream left, or no rows if it never wrote one."""
    table = tables.read_table(spark, path, like.schema)
    return spark.createDataFrame([], like.schema) if table is None else table


def drain_upsert(spark: SparkSession, sf_dir: str, name: str, of: Callable[[DataFrame], DataFrame], keys: list[str],
                 partition_by: list[str], output_mode: str = "update") -> DataFrame:
    """Run ``of(landing stream)`` to completion into a keyed parquet table and read it back."""
    base = run_dir(spark, name)
    stream = of(landing_stream(spark, sf_dir, base))
    sink = st.upsert_sink(spark, f"{base}/table", keys, partition_by)
    st.run_available_now(stream, sink, f"{base}/checkpoint", output_mode)
    return read_or_empty(spark, f"{base}/table", stream)


def epochs_into(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: one overwrite-per-epoch folder (replay-safe)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")

    return write


def drain_append(spark: SparkSession, sf_dir: str, name: str, of: Callable[[DataFrame], DataFrame],
                 flush: bool = False) -> DataFrame:
    """Run ``of(landing stream)`` to completion into a table with a folder per epoch."""
    base = run_dir(spark, name)
    stream = of(landing_stream(spark, sf_dir, base, flush))
    st.run_available_now(stream, epochs_into(f"{base}/table"), f"{base}/checkpoint", "append")
    return read_or_empty(spark, f"{base}/table", stream)


def drain_split(spark: SparkSession, sf_dir: str, name: str, of: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Run ``of(landing stream with stragglers)``, marked with its lateness; the on-time and the late rows."""
    base = run_dir(spark, name)
    marked = late.with_lateness(of(spark.sql(LANDING_VIEW_SQL, events=late_events(spark, sf_dir, base))))
    rows = marked.drop("late_by_sec")
    st.run_available_now(marked, late.split_sink(epochs_into(f"{base}/table"), f"{base}/late"), f"{base}/checkpoint", "append")
    return read_or_empty(spark, f"{base}/table", rows), read_or_empty(spark, f"{base}/late", marked)


def drain_pipeline(spark: SparkSession, sf_dir: str, name: str, rules: Rules) -> str:
    """Stream the landing records through the whole pipeline; the folder of its tables."""
    base = run_dir(spark, name)
    sink = st.pipeline_sink(spark, f"{base}/tables", rules, name)
    st.run_available_now(landing_stream(spark, sf_dir, base), sink, f"{base}/checkpoint", "append")
    return f"{base}/tables"
