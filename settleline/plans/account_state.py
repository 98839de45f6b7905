"""Alerts over all stored transactions, kept up by what a batch changes.

State, one ``CommitLog`` with three parts that change together:

* ``days``    (account, day): day totals and the day's part of the time rules;
* ``totals``  account: greatest trailing count and the sums over its days;
* ``alerts``  alert id: the alert, the batch and time that raised or last changed it.

Rows carry the number of the commit that wrote them, and the latest row of a key
counts.  A batch works out again only its accounts' days that it can have changed:
its dates, and as many days after them as the look-back reaches.  The differences
to the stored days, summed per account, move the totals; alerts follow from changed
totals and changed days, and one that stands as it was is not written.  So a batch
writes rows of accounts that it touches alone, and reads of ``processed`` the dates
around its own.

The transactions table only grows, so counts, days and alerts never go away, and a
greatest trailing count only rises: sums take signed differences, the maximum takes
the greater.  All three parts become visible in one step; a batch that fails before
leaves the old state, and running it again (or any later batch with the same rows)
starts from that.  After ``COMPACT_AFTER`` commits the latest rows replace the log.
State of other rule parameters is worked out anew from ``processed``.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Rules
from ..operators import anomalies
from ..schema import ALERT_COLUMNS
from ..sinks import tables
from ..sinks.commits import CommitLog, latest

PARTS = {"days": ["account_id", "day"], "totals": ["account_id"], "alerts": ["alert_id"]}
DAY_VALUES = ["day_amt", "day_n", "hf_max", "hf_amt", "rs_n", "rs_amt"]
SUMS = ["hf_amt", "rs_n", "rs_amt"]
COMPACT_AFTER = 32

_DAYS = "account_id string, day date, day_amt decimal(38,2), day_n bigint, hf_max bigint, hf_amt decimal(38,2), rs_n bigint, rs_amt decimal(38,2)"
_TOTALS = "account_id string, hf_max bigint, hf_amt decimal(38,2), rs_n bigint, rs_amt decimal(38,2)"
_ALERTS = ("alert_id string, account_id string, alert_type string, alert_description string, transaction_count bigint, total_amount decimal(38,2), "
           "alert_date date, batch_id string, detection_time timestamp")
SCHEMAS = {"days": _DAYS, "totals": _TOTALS, "alerts": _ALERTS}


def look_back_days(rules: Rules) -> int:
    return -(-max(rules.burst_window_sec, rules.rapid_gap_sec) // anomalies.DAY_SEC)


def rules_mark(rules: Rules) -> str:
    """Names the parameters that the state depends on."""
    used = (rules.burst_window_sec, rules.burst_min_exclusive, rules.rapid_gap_sec, rules.daily_amount_limit)
    return hashlib.md5(repr(used).encode()).hexdigest()[:16]


def stored(log: CommitLog, part: str) -> DataFrame:
    """The latest row of every key of a part."""
    rows = log.read(f"{SCHEMAS[part]}, seq bigint", part)
    return log.spark.createDataFrame([], SCHEMAS[part]) if rows is None else latest(rows, PARTS[part])


def alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts that stand."""
    return stored(CommitLog(spark, path), "alerts")


def _spread(dates: DataFrame, before: int, after: int) -> DataFrame:
    """The dates from ``before`` days ahead of each to ``after`` days behind it, once."""
    days = F.sequence(F.date_sub("d", before), F.date_add("d", after))
    return dates.select(F.explode(days).alias("d")).distinct()


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in fields])


def update(spark: SparkSession, path: str, processed: DataFrame, accounts: DataFrame, dates: DataFrame, rules: Rules,
           batch_id: str) -> int:
    """Bring the state up to date with ``processed`` after rows of ``accounts`` (``account_id``) came in
    on ``dates`` (``d``), both staged; the number of alerts raised or changed."""
    log, mark = CommitLog(spark, path), rules_mark(rules)
    current = log.current()
    anew = bool(current) and current[-1].note != mark
    compact = not anew and len(current) >= COMPACT_AFTER
    name, seq = uuid.uuid4().hex, F.lit(log.next_number()).cast("bigint").alias("seq")

    def write(rows: DataFrame, part: str) -> DataFrame:
        _typed(rows, SCHEMAS[part]).select("*", seq).write.parquet(log.folder(name, part))
        return spark.read.schema(f"{SCHEMAS[part]}, seq bigint").parquet(log.folder(name, part)).drop("seq")

    # days that the batch can have changed, worked out from the rows around them
    if anew or not current:
        days = anomalies.account_days(anomalies.second_profile(processed, rules), rules)
        old_days, old_totals = (spark.createDataFrame([], SCHEMAS[p]) for p in ("days", "totals"))
    else:
        back = look_back_days(rules)
        around = tables.within_dates(processed, "transaction_date", _spread(dates, back, back))
        own = around.join(accounts, "account_id", "left_semi")
        reach = _spread(dates, 0, back)
        days = tables.within_dates(anomalies.account_days(anomalies.second_profile(own, rules), rules), "day", reach)
        old_days = tables.within_dates(stored(log, "days"), "day", reach).join(accounts, "account_id", "left_semi")
        old_totals = stored(log, "totals").join(accounts, "account_id", "left_semi")
    was = old_days.select("account_id", "day", *[F.col(c).alias(f"_{c}") for c in DAY_VALUES])
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DAY_VALUES])
    staging = tables.staging_path(spark, path)
    _typed(days, _DAYS).join(was, ["account_id", "day"], "left").where(differs).write.parquet(f"{staging}/days")
    changed = spark.read.parquet(f"{staging}/days")

    # signed differences per account move its totals
    moved = changed.groupBy("account_id").agg(F.max("hf_max").alias("hf_max"), *[
        F.sum(F.coalesce(c, F.lit(0)) - F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in SUMS])
    moved = moved.join(old_totals.select("account_id", *[F.col(c).alias(f"_{c}") for c in ("hf_max", *SUMS)]), "account_id", "left")
    totals = write(moved.select("account_id", F.greatest("hf_max", "_hf_max").alias("hf_max"), *[
        (F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in SUMS]), "totals")
    write(changed.select("account_id", "day", *DAY_VALUES), "days")

    # alerts of what changed; those that stand keep the batch and time they were raised by
    ident = F.concat_ws("|", "account_id", "alert_type", F.coalesce(F.col("alert_date").cast("string"), F.lit("")))
    found = anomalies.alerts_of_totals(totals, rules).unionByName(anomalies.alerts_of_days(changed, rules))
    found = found.select(F.sha2(ident, 256).alias("alert_id"), *ALERT_COLUMNS)
    before = stored(log, "alerts").where(F.lit(not anew)).join(found.select("alert_id"), "alert_id", "left_semi").select(
        "alert_id", F.col("alert_description").alias("_text"), F.col("total_amount").alias("_total"), F.col("transaction_count").alias("_n"))
    same = (F.col("_text") == F.col("alert_description")) & (F.col("_total") == F.col("total_amount")) & (F.col("_n") == F.col("transaction_count"))
    new = found.join(before, "alert_id", "left").where(~F.coalesce(same, F.lit(False))).select(
        *found.columns, F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("detection_time"))
    counter = Observation(f"alerts-{name}")
    write(new.observe(counter, F.count(F.lit(1)).alias("n")), "alerts")
    raised = counter.get["n"]
    tables.delete_path(spark, staging)
    log.publish(name, replaces=anew, note=mark)
    if compact:
        _compact(log, mark)
    return raised


def _compact(log: CommitLog, mark: str) -> None:
    """The latest row of every key replaces the log."""
    name, seq = uuid.uuid4().hex, F.lit(log.next_number()).cast("bigint").alias("seq")
    for part in PARTS:
        stored(log, part).select("*", seq).write.parquet(log.folder(name, part))
    log.publish(name, replaces=True, note=mark)
