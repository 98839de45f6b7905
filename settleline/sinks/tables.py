"""Keyed writes to partitioned parquet tables (the warehouse, re-aimed at files).

* insert-if-absent (``ON CONFLICT DO NOTHING``): first-delivery de-duplication of
  the batch, then a left-anti join against the keys already stored (only the key
  columns of the target are read, or with ``indexed`` its hash-bucketed key index,
  which isn't shuffled), then append.
* upsert (``ON CONFLICT DO UPDATE``): the touched partitions are rebuilt as
  (stored rows whose key is not in the batch) + batch rows, staged under the
  session's shared checkpoint folder, then swapped in with dynamic partition
  overwrite (partitions the batch does not touch are left alone).
* append with a deterministic id, so re-running a batch inserts nothing new.

Every write goes through Spark's file commit protocol, so a lost executor only
retries its task.  Appends and partitioned overwrites leave the previous state
when a job fails; tables that are replaced whole, or in several parts at once, are
``commits.CommitLog`` tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..session import checkpoint_dir
from .key_index import KeyIndex


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library staged (after the data it held has been swapped in)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, or None if nothing is there.  A table that is there but
    can't be read raises: taking it for absent would overwrite it."""
    if not _exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# Pure DataFrame forms (also used by the registered queries) --------------------
def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    # Null-safe: a NULL partition value (e.g. an unparseable date) still identifies its rows.
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def rows_to_insert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is absent from ``target`` (batch keys assumed unique)."""
    if target is None:
        return batch
    stored = target.select(*keys)
    return batch.join(stored, _same_keys(batch, stored, keys), "left_anti")


def merged_insert_if_absent(target: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table state after insert-if-absent: stored rows win over redelivered ones."""
    new = rows_to_insert(target, batch, keys)
    return new if target is None else target.unionByName(new)


def merged_upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table state after upsert: batch rows replace stored rows with the same key."""
    if target is None:
        return batch
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch)


# Writers ---------------------------------------------------------------------
def _partitioned(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows grouped for a partitioned write: AQE's rebalance hint gives each partition
    value a few advisory-sized files (a hot date is split, small ones are coalesced)
    instead of one small file per task per value."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def staging_path(spark: SparkSession, path: str) -> str:
    base = checkpoint_dir(spark, fallback=f"{path.rstrip('/')}__staging")
    return f"{base.rstrip('/')}/settleline-staging/{uuid.uuid4().hex}"


def value_range(rows: DataFrame, col: str) -> tuple:
    """(least, greatest, number of NULLs) of a column: one row, whatever the data's size."""
    return tuple(rows.agg(F.min(col), F.max(col), F.count_if(F.col(col).isNull())).first())


def within_range(rows: DataFrame, col: str, bounds: tuple) -> DataFrame:
    """Rows whose ``col`` lies in the range, as a literal filter (prunes partitions when planned)."""
    lo, hi, nulls = bounds
    cond = F.col(col).between(lo, hi) if lo is not None else F.lit(False)
    return rows.filter(cond | F.col(col).isNull() if nulls else cond)


def within_dates(rows: DataFrame, col: str, dates: DataFrame) -> DataFrame:
    """Rows whose ``col`` is one of ``dates`` (a column ``d``, staged; as many as calendar days).

    A semi join with the dates broadcast: where ``rows`` is partitioned by ``col``, dynamic
    pruning reads these partitions alone, not those in between.
    """
    known = dates.where(F.col("d") >= F.lit("0001-01-01").cast("date"))
    return rows.join(F.broadcast(known), F.col(col) == F.col("d"), "left_semi")


def insert_if_absent(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
                     partition_by: Sequence[str] = (), among: Column | None = None, indexed: bool = False) -> None:
    """Append the batch rows whose key is not stored yet (idempotent on re-run).

    Of the stored rows only the key columns are read, and with ``among`` (a literal
    condition that the batch's keys are known to meet) only those partitions.  With
    ``indexed`` (one key column, a string that is never null) the keys are looked up in
    the table's bucketed index, which is brought up to date before and after.
    The batch's plan runs once.
    """
    if indexed:
        (key,) = keys
        index = KeyIndex(spark, path, key)
        index.catch_up()
        writer = _partitioned(index.absent(batch), partition_by).write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        index.catch_up()
        return
    target = read_table(spark, path, batch.schema)
    if target is not None and among is not None:
        target = target.filter(among)
    writer = _partitioned(rows_to_insert(target, batch, keys), partition_by).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str],
           partition_by: Sequence[str] = (), staged: bool = False) -> None:
    """Replace rows by key; with ``partition_by`` only the touched partitions are rewritten,
    without it the (small, key-level) table is rewritten whole.

    The batch is staged first, so its plan runs once (``staged``: it is read from files
    already).  Of the stored side exactly the batch's partition values are read if they
    are dates, else their range (least to greatest); the exact keys are matched by the
    anti join.
    """
    target = read_table(spark, path, batch.schema)
    if target is None:
        _overwrite(_partitioned(batch, partition_by), path, partition_by)
        return
    staging = staging_path(spark, path)
    rows = batch
    if not staged:
        batch.write.parquet(f"{staging}/batch")
        rows = spark.read.schema(batch.schema).parquet(f"{staging}/batch")
    for col in partition_by:
        values = value_range(rows, col)
        if rows.schema[col].dataType == DateType() and not values[2]:
            target = within_dates(target, col, rows.select(F.col(col).alias("d")).distinct())
        else:
            target = within_range(target, col, values)
    replace_rows(spark, merged_upsert(target, rows, keys), path, partition_by, staging)


def replace_rows(spark: SparkSession, rows: DataFrame, path: str, partition_by: Sequence[str] = (),
                 staging: str | None = None) -> None:
    """Put ``rows`` in place of the partitions they have (of the whole table without
    partitioning); they may be derived from the table itself, so they are staged first."""
    staging = staging or staging_path(spark, path)
    rows.write.parquet(f"{staging}/rows")
    _overwrite(_partitioned(spark.read.schema(rows.schema).parquet(f"{staging}/rows"), partition_by), path, partition_by)
    delete_path(spark, staging)


def _overwrite(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def raw_landing_rows(landing: DataFrame) -> DataFrame:
    """Rows for the raw landing table: every record with a usable id (valid or not),
    first delivery per id by its timestamp text; id-less rows only live in quarantine."""
    from ..operators.enrich import first_delivery
    from ..sources.landing import CORRUPT

    keyed = landing.drop(CORRUPT).filter(F.col("transaction_id").isNotNull() & (F.col("transaction_id") != ""))
    return first_delivery(keyed, key="transaction_id", order_by="timestamp")


def write_snapshots(output_path: str, processed: DataFrame, settlements: DataFrame, alerts: DataFrame) -> None:
    """Plain parquet overwrite of the three batch outputs; processed is partitioned by
    transaction_date and only the dates present in this batch are replaced."""
    root = output_path.rstrip("/")
    (_partitioned(processed, ["transaction_date"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("transaction_date").parquet(f"{root}/processed"))
    settlements.write.mode("overwrite").parquet(f"{root}/settlements")
    alerts.write.mode("overwrite").parquet(f"{root}/anomalies")


def with_alert_ids(alerts: DataFrame, batch_id: str) -> DataFrame:
    """Deterministic alert_id = sha2(batch, account, type, date) and a detection time."""
    ident = F.concat_ws(
        "|", F.lit(batch_id), F.col("account_id"), F.col("alert_type"),
        F.coalesce(F.col("alert_date").cast("string"), F.lit("")),
    )
    return alerts.select(
        F.sha2(ident, 256).alias("alert_id"),
        *alerts.columns,
        F.lit(batch_id).alias("batch_id"),
        F.current_timestamp().alias("detection_time"),
    )


def append_alerts(spark: SparkSession, alerts: DataFrame, path: str, batch_id: str) -> None:
    """Append a batch's alerts.  The id includes the batch id, so a re-run can only
    collide with alerts of the same batch: the table is partitioned by batch_id and
    the existence check reads that one partition, not the whole alert history."""
    insert_if_absent(spark, with_alert_ids(alerts, batch_id), path, ["batch_id", "alert_id"],
                     partition_by=["batch_id"], among=F.col("batch_id") == batch_id)


def quality_row(spark: SparkSession, batch_id: str, report: dict) -> DataFrame:
    """One data-quality log row from the (already computed) report dict."""
    schema = (
        "batch_id string, total_records bigint, valid_records bigint, invalid_records bigint, "
        "error_breakdown map<string,bigint>"
    )
    row = (batch_id, report["total"], report["valid"], report["invalid"], report["error_breakdown"])
    return spark.createDataFrame([row], schema).withColumn("processed_at", F.current_timestamp())


def log_quality(spark: SparkSession, path: str, batch_id: str | None, report: dict) -> str:
    batch_id = batch_id or str(uuid.uuid4())
    insert_if_absent(spark, quality_row(spark, batch_id, report), path, ["batch_id"])
    return batch_id
