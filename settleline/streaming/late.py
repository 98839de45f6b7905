"""Late rows as a side output: kept with their lateness, not only counted.

Spark drops rows behind the watermark inside its stateful operators without a
trace but a count.  ``with_lateness`` reads the watermark itself, in a keyed
operator that keeps no state, and marks every row; nothing is dropped.  The caller
sends the marked rows to a table of their own and the others on.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sinks import tables

#: Keys that the rows of a micro-batch are spread over.
SPREAD = 64


def with_lateness(rows: DataFrame, id_col: str = "transaction_id", spread: int = SPREAD) -> DataFrame:
    """``rows`` (watermarked on ``event_time``) with ``late_by_sec``: how far the row is behind the
    watermark of its trigger, null if it is not late."""
    schema = T.StructType([*[f for f in rows.schema.fields], T.StructField("late_by_sec", T.LongType())])

    def mark(key: Any, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark_ms = state.getCurrentWatermarkMs()
        for part in parts:
            behind = (mark_ms - part["_at_ms"]) // 1000
            part = part.drop(columns=["_spread", "_at_ms"])
            part["late_by_sec"] = behind.clip(lower=0)
            yield part

    # the instant as a number: pandas would see it in the session's time zone
    spread_over = F.pmod(F.xxhash64(id_col), F.lit(spread)).alias("_spread")
    marked = rows.select("*", spread_over, F.unix_millis("event_time").alias("_at_ms")).groupBy("_spread").applyInPandasWithState(
        mark, schema, "none int", "append", GroupStateTimeout.NoTimeout)
    return marked.withColumn("late_by_sec", F.nullif("late_by_sec", F.lit(0).cast("long")))


def split_sink(on_time, late_path: str):
    """foreachBatch function: late rows into the table at ``late_path`` (a folder per epoch, so a
    replayed epoch writes the same rows again in place), the others to ``on_time(batch, epoch)``."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        staging = tables.staging_path(spark, late_path)
        batch.write.parquet(staging)
        rows = spark.read.schema(batch.schema).parquet(staging)
        rows.where("late_by_sec IS NOT NULL").write.mode("overwrite").parquet(f"{late_path}/epoch={epoch_id}")
        on_time(rows.where("late_by_sec IS NULL").drop("late_by_sec"), epoch_id)
        tables.delete_path(spark, staging)

    return write
