"""HIGH_FREQUENCY in keyed state: the alert leaves in the trigger that causes it.

Key: (shard, bucket).  An account's time is cut into buckets of ``bucket_sec``;
a row goes to its own bucket and, if it lies in the last ``burst_window_sec``
seconds of it, also to the next one (the "halo"), so each bucket can count the
trailing windows of its own rows by itself and a busy account is spread over its
buckets.  Accounts are dealt into ``SHARDS``, whose accounts share a key: a call of
the state function serves all of them by array operations, so calls grow with shards
and buckets, not with quiet accounts.  State of a key: one value with the rows and
cents of every (account, second), at most ``bucket_sec + burst_window_sec`` seconds
of an account whatever the volume, read and written once in a call.  An event-time
timer at the bucket's end plus the look-back clears it once the watermark has passed.

Rows of a micro-batch are summed per second before the state is touched; an account's
result is handed out only if it has changed, so the sink's upsert on (account, bucket)
keeps the latest.  Needs the RocksDB state store (see ``rocksdb_state``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import HIGH_FREQUENCY, Rules
from ..functions import alert_text
from ..schema import ALERT_COLUMNS, MONEY_SUM_TYPE

#: Key of the table of bucket results, and its partitioning.
BUCKET_KEYS = ["account_id", "bucket"]
BUCKET_PARTITION = ["day"]

#: Shards of a bucket; raise it with the number of accounts, so that a shard's stay a small array.
SHARDS = 64

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's setting comes back after."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def default_bucket(rules: Rules) -> int:
    """Four look-backs: a quarter of the rows has a copy in the next bucket."""
    return 4 * rules.burst_window_sec


def summed(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ``at`` in order and the sums of their rows of ``values``."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], np.add.reduceat(values[order], first, axis=0)


class TrailingCounts(StatefulProcessor):
    """Greatest trailing count of a bucket's rows, and the amount of those over the limit, per account."""

    def __init__(self, window_sec: int, min_exclusive: int, bucket_sec: int):
        self.window_sec, self.min_exclusive, self.bucket_sec = window_sec, min_exclusive, bucket_sec
        self.span = bucket_sec + 3 * window_sec  # places of an account, so that no look-back reaches the one before

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the accounts as JSON; places (account's number x span + second of the bucket), rows and cents as 64-bit integers
        self.held = handle.getValueState("held", "accounts string, packed binary")

    def results(self, accounts: list, at: np.ndarray, values: np.ndarray) -> dict:
        """Account -> (greatest trailing count, cents) of those over the limit."""
        if not at.size:
            return {}
        upto = np.concatenate([[0], values[:, 0].cumsum()])
        trailing = upto[1:] - upto[np.searchsorted(at, at - self.window_sec, "left")]
        over = (at % self.span >= self.window_sec) & (trailing > self.min_exclusive)
        if not over.any():
            return {}
        of, trailing, cents = at[over] // self.span, trailing[over], values[over, 1]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        found = zip(of[first].tolist(), np.maximum.reduceat(trailing, first).tolist(), np.add.reduceat(cents, first).tolist())
        return {accounts[k]: (n, c) for k, n, c in found}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        bucket = int(key[1])
        start = bucket * self.bucket_sec - self.window_sec
        stored = self.held.get()
        if stored is None:  # the bucket's first rows
            self.handle.registerTimer(((bucket + 1) * self.bucket_sec + self.window_sec) * 1000)
            accounts, packed = [], np.empty((0, 3), np.int64)
        else:
            accounts, packed = json.loads(stored[0]), np.frombuffer(stored[1], "<i8").reshape(-1, 3)
        before = self.results(accounts, packed[:, 0], packed[:, 1:])
        number = {a: k for k, a in enumerate(accounts)}
        parts = [packed]
        for part in rows:
            codes, names = pd.factorize(part["account_id"])
            of = np.array([number.setdefault(a, len(number)) for a in names], np.int64)[codes]
            at, sums = summed(of * self.span + part["sec"].to_numpy(np.int64) - start,
                              np.column_stack([np.ones(len(part), np.int64), part["cents"].to_numpy(np.int64)]))
            parts.append(np.column_stack([at, sums]))
        every = np.concatenate(parts)
        at, values = summed(every[:, 0], every[:, 1:])
        accounts = list(number)
        self.held.update((json.dumps(accounts), np.column_stack([at, values]).astype("<i8").tobytes()))
        now = [(a, bucket, n, c) for a, (n, c) in self.results(accounts, at, values).items() if before.get(a) != (n, c)]
        if now:
            yield pd.DataFrame(now, columns=["account_id", "bucket", "trailing", "cents"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter([])

    def close(self) -> None:
        pass


def burst_buckets(enriched: DataFrame, rules: Rules, bucket_sec: int | None = None, shards: int = SHARDS) -> DataFrame:
    """``(account_id, bucket, day, transaction_count, total_amount)`` of every bucket over the
    limit, whenever it changes (a stream in update mode; ``enriched`` has a watermark)."""
    bucket_sec = max(bucket_sec or default_bucket(rules), rules.burst_window_sec)
    sec = F.unix_seconds("event_time")
    rows = enriched.select("account_id", "event_time", sec.alias("sec"), (F.col("amount") * 100).cast("long").alias("cents"))
    own = F.floor(F.col("sec") / bucket_sec)
    spill = F.when(F.col("sec") >= (own + 1) * bucket_sec - rules.burst_window_sec, own + 1)
    keyed = rows.select("*", F.explode(F.filter(F.array(own, spill), lambda b: b.isNotNull())).alias("bucket"))
    shard = F.pmod(F.xxhash64("account_id"), F.lit(shards))
    found = keyed.withColumn("shard", shard).groupBy("shard", "bucket").transformWithStateInPandas(
        TrailingCounts(rules.burst_window_sec, rules.burst_min_exclusive, bucket_sec),
        "account_id string, bucket long, trailing long, cents long", "Update", "EventTime")
    return found.select(
        "account_id", "bucket", F.date_from_unix_date(F.floor(F.col("bucket") * bucket_sec / 86400).cast("int")).alias("day"),
        F.col("trailing").alias("transaction_count"), (F.col("cents").cast("decimal(20,0)") / 100).cast(MONEY_SUM_TYPE).alias("total_amount"))


def alerts_from_buckets(table: DataFrame, rules: Rules) -> DataFrame:
    """HIGH_FREQUENCY alerts from the upserted bucket results."""
    per_account = table.groupBy("account_id").agg(
        F.max("transaction_count").alias("transaction_count"), F.sum("total_amount").cast(MONEY_SUM_TYPE).alias("total_amount"))
    return per_account.select(
        "account_id", F.lit(HIGH_FREQUENCY).alias("alert_type"), alert_text.high_frequency(F.col("transaction_count"), rules).alias("alert_description"),
        "transaction_count", "total_amount", F.lit(None).cast("date").alias("alert_date")).select(*ALERT_COLUMNS)


def hopping_frequency(enriched: DataFrame, rules: Rules, slide: str = "5 minutes") -> DataFrame:
    """The cheap, coarser variant in append mode, without Python: accounts with more than the limit
    in a window of ``burst_window_sec`` that starts at a multiple of ``slide``.

    Rows are first summed into tumbling panes of one slide; only the panes are copied
    into the windows that hold them, so the state grows with panes, not with rows.
    The look-back is a multiple of the slide.
    """
    size = f"{rules.burst_window_sec} seconds"
    panes = enriched.groupBy("account_id", F.window("event_time", slide).alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amt"))
    windows = panes.groupBy("account_id", F.window(F.window_time("pane"), size, slide).alias("w")).agg(
        F.sum("n").alias("transaction_count"), F.sum("amt").cast(MONEY_SUM_TYPE).alias("total_amount"))
    return windows.where(F.col("transaction_count") > rules.burst_min_exclusive).select(
        "account_id", F.unix_seconds("w.start").alias("window_start"), F.unix_seconds("w.end").alias("window_end"),
        "transaction_count", "total_amount")


def burst_flags(enriched: DataFrame, window_sec: int = 60, min_exclusive: int = 5) -> DataFrame:
    """Streaming twin of ``operators.enrich.with_burst_flag`` in append mode: ``(transaction_id,
    is_suspicious)`` once the watermark has passed the row's bucket.

    An account's rows gather per second, and the seconds of a time bucket, with the counts of
    the ``window_sec`` before it, in one value of at most ``width + window_sec`` seconds
    however busy the account is, where each second adds up its look-back.  No row is compared
    with another, each is read, checked and kept in state once, and a busy account is spread over
    its buckets.  Rows leave, and the state with them, when the watermark has passed their bucket.
    """
    width = 4 * window_sec
    seconds = enriched.groupBy("account_id", F.window("event_time", "1 second").alias("second")).agg(
        F.collect_list(F.struct("transaction_id", "is_suspicious")).alias("rows")).select(
        "account_id", F.window_time("second").alias("at"), F.unix_seconds("second.start").alias("sec"), F.size("rows").alias("n"), "rows")
    bucket = F.window("at", f"{width + window_sec} seconds", f"{width} seconds", f"{width - window_sec} seconds")
    home = F.col("sec") >= F.unix_seconds("bucket.start") + window_sec
    copies = seconds.select("account_id", bucket.alias("bucket"), "sec", "n", "rows").select(
        "account_id", "bucket", "sec", "n", F.when(home, F.col("rows")).alias("rows"))
    held = copies.groupBy("account_id", "bucket").agg(F.sort_array(F.collect_list(F.struct("sec", "n", "rows"))).alias("held"))

    def trailing(x, i):
        """The rows of a second's look-back, which is among the ``window_sec`` seconds held before it."""
        near = F.slice("held", F.greatest(F.lit(1), i + 1 - window_sec), F.lit(window_sec + 1))
        return F.aggregate(near, F.lit(0).cast("long"), lambda n, y: n + F.when(y["sec"].between(x["sec"] - window_sec, x["sec"]), y["n"]).otherwise(0))

    counted = F.transform("held", lambda x, i: F.struct(x["rows"].alias("rows"), (trailing(x, i) > min_exclusive).alias("burst")))
    flagged = held.select(F.explode(counted).alias("s")).select(F.explode("s.rows").alias("row"), F.col("s.burst").alias("burst"))
    return flagged.select("row.transaction_id", (F.col("row.is_suspicious") | F.col("burst")).alias("is_suspicious"))
