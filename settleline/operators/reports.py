"""The five standing reports as DataFrame functions over processed/settlement/alert tables.

Hand-applied rewrites (all exact):
* top-k before join/rank: the top-10/top-20 rows are chosen first, then the
  alerts are filtered by their accounts and summed (RPT-2) or the ranks are
  computed (RPT-4) on at most k rows, so no global single-partition window and
  only k-row broadcasts.
* RPT-5's per-account LAG/LEAD runs inside (account, time-bucket) partitions;
  what happens across bucket edges is settled by folding bucket summaries into
  days and days into the account, so a hot account is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rules
from ..functions.derive import exact_mean, exact_percent
from ..functions.parsing import epoch_seconds
from ..schema import AMOUNT_TYPE, MONEY_SUM_TYPE

PCT_TYPE = "decimal(20,2)"
SCORE_TYPE = "decimal(6,3)"


def _suspicious_count():
    return F.count_if(F.col("is_suspicious") == F.lit(True))


# RPT-1 -----------------------------------------------------------------------
def settlement_summary(settlements: DataFrame) -> DataFrame:
    """Settlement rows + day-over-day absolute and percentage change (per type, date order)."""
    by_type = Window.partitionBy("transaction_type").orderBy("settlement_date")
    prev = F.lag("total_amount", 1).over(by_type)
    change = F.col("total_amount") - prev
    pct = F.round(
        (change * F.lit(100)).cast("decimal(38,2)").cast("decimal(24,2)")
        / F.nullif(prev, F.lit(0)).cast("decimal(22,2)"),
        2,
    )
    return settlements.select(
        "settlement_date",
        "transaction_type",
        "transaction_count",
        "total_amount",
        "avg_amount",
        "flagged_count",
        "running_total",
        change.cast(MONEY_SUM_TYPE).alias("dod_change"),
        pct.cast(PCT_TYPE).alias("dod_pct_change"),
    ).orderBy(F.col("settlement_date").desc_nulls_first(), F.col("transaction_type"))


# Per-day partials -------------------------------------------------------------
#: What a row of ``partials`` is about.
ACCOUNT, HOUR, MERCHANT = "account", "hour", "merchant"


def _sums() -> list[Column]:
    return [F.count("transaction_id").alias("ids"), F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amt"), _suspicious_count().alias("susp")]


def partials(processed: DataFrame) -> DataFrame:
    """``(transaction_date, kind, account_id, transaction_hour, merchant_id, ids, rows, amt, susp)``: the
    sums of each date per account, per hour and per merchant, in one pass.

    They add up: RPT-2, RPT-3 and RPT-4 come from them alone, and a date can be worked out again
    on its own.  Distinct dates are counted as rows, since an account has one row a date.
    """
    by = ["account_id", "transaction_hour", "merchant_id"]
    kind = F.when(F.grouping("account_id") == 0, ACCOUNT).when(F.grouping("transaction_hour") == 0, HOUR).otherwise(MERCHANT)
    return processed.groupingSets([["transaction_date", c] for c in by], "transaction_date", *by).agg(
        kind.alias("kind"), *_sums()).select("transaction_date", "kind", *by, "ids", "rows", "amt", "susp")


def account_part(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") == ACCOUNT).select("transaction_date", "account_id", "ids", "rows", "amt", "susp")


def hour_part(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") == HOUR).select("transaction_hour", "rows", "amt", "susp")


def merchant_part(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") == MERCHANT).select("merchant_id", "rows", "amt", "susp")


# RPT-2 -----------------------------------------------------------------------
def account_days(processed: DataFrame) -> DataFrame:
    """Per (account, date): the sums that ``account_activity`` adds up."""
    return processed.groupBy("account_id", "transaction_date").agg(*_sums())


def account_activity(per_day: DataFrame) -> DataFrame:
    """Per account: counts, volume, active days, suspicious count.

    Two-level aggregation (account-day, then account) instead of COUNT(DISTINCT
    date): the same numbers without the row-doubling Expand of a distinct
    aggregate, and the account-day level pre-aggregates map-side.
    """
    return per_day.groupBy("account_id").agg(
        F.sum("ids").alias("total_transactions"),
        F.sum("amt").cast(MONEY_SUM_TYPE).alias("total_volume"),
        F.sum("amt").alias("_sum"),
        F.sum("rows").alias("_n"),
        F.count("transaction_date").alias("active_days"),
        F.sum("susp").alias("suspicious_count"),
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Per account: alert count and the distinct alert types, sorted, joined by ', '."""
    return alerts.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.array_join(F.sort_array(F.collect_set("alert_type")), ", ").alias("alert_types"),
    )


def top_accounts(processed: DataFrame, alerts: DataFrame, k: int = 10) -> DataFrame:
    """Top-k accounts by volume, with their alert count/types (0 / 'NONE' if none), in that order."""
    return top_accounts_of(account_days(processed), alerts, k)


def top_accounts_of(per_day: DataFrame, alerts: DataFrame, k: int = 10) -> DataFrame:
    """The same from (account, date) sums."""
    top = (
        account_activity(per_day)
        .orderBy(F.col("total_volume").desc(), F.col("account_id"))
        .limit(k)
    )
    # Both joins build on at most k rows: the alerts are filtered by the k accounts
    # before they are summed, so what grows with the alerts is only streamed.
    own = alerts.select("account_id", "alert_type").join(F.broadcast(top.select("account_id")), "account_id", "left_semi")
    joined = top.join(F.broadcast(alert_summary(own)), "account_id", "left")
    return joined.select(
        "account_id",
        "total_transactions",
        "total_volume",
        exact_mean(F.col("_sum"), F.col("_n"), 2).cast(AMOUNT_TYPE).alias("avg_transaction_amount"),
        "active_days",
        "suspicious_count",
        F.coalesce(F.col("alert_count"), F.lit(0)).cast("long").alias("alert_count"),
        F.coalesce(F.col("alert_types"), F.lit("NONE")).alias("alert_types"),
    ).orderBy(F.col("total_volume").desc(), F.col("account_id"))


# RPT-3 -----------------------------------------------------------------------
def hourly_risk(processed: DataFrame) -> DataFrame:
    """Per hour of day: counts, amounts, suspicious rate and a risk band."""
    return hourly_risk_of(processed.groupBy("transaction_hour").agg(*_sums()))


def hourly_risk_of(sums: DataFrame) -> DataFrame:
    """The same from sums per hour (of each date, or of all)."""
    stats = sums.groupBy("transaction_hour").agg(
        F.sum("rows").alias("total_transactions"),
        F.sum("amt").alias("_sum"),
        F.sum("susp").alias("suspicious_count"),
    )
    rate = exact_percent(F.col("suspicious_count"), F.col("total_transactions"))
    return stats.select(
        "transaction_hour",
        "total_transactions",
        F.col("_sum").cast(MONEY_SUM_TYPE).alias("total_amount"),
        exact_mean(F.col("_sum"), F.col("total_transactions"), 2).cast(AMOUNT_TYPE).alias("avg_amount"),
        "suspicious_count",
        rate.alias("anomaly_rate_pct"),
    ).withColumn(
        "risk_level",
        F.when(F.col("anomaly_rate_pct") > 20, F.lit("HIGH RISK"))
        .when(F.col("anomaly_rate_pct") > 10, F.lit("MEDIUM RISK"))
        .otherwise(F.lit("LOW RISK")),
    ).orderBy("transaction_hour")


# RPT-4 -----------------------------------------------------------------------
def merchant_risk(processed: DataFrame, k: int = 20, min_transactions: int = 5) -> DataFrame:
    """Merchants with >= 5 transactions ranked by suspicious share; top k by rank."""
    return merchant_risk_of(processed.groupBy("merchant_id").agg(*_sums()), k, min_transactions)


def merchant_risk_of(sums: DataFrame, k: int = 20, min_transactions: int = 5) -> DataFrame:
    """The same from sums per merchant (of each date, or of all)."""
    stats = (
        sums.groupBy("merchant_id")
        .agg(
            F.sum("rows").alias("total_transactions"),
            F.sum("amt").cast(MONEY_SUM_TYPE).alias("total_volume"),
            F.sum("susp").alias("flagged_transactions"),
        )
        .filter(F.col("total_transactions") >= min_transactions)
        .withColumn("flagged_pct", exact_percent(F.col("flagged_transactions"), F.col("total_transactions")))
    )
    # rank/dense_rank of a row depend only on the rows before it in the order,
    # so ranking the top k rows gives their global ranks.
    top = stats.orderBy(F.col("flagged_pct").desc(), F.col("merchant_id")).limit(k)
    order = Window.orderBy(F.col("flagged_pct").desc())
    return top.select(
        "merchant_id",
        "total_transactions",
        "total_volume",
        "flagged_transactions",
        "flagged_pct",
        F.rank().over(order).cast("long").alias("risk_rank"),
        F.dense_rank().over(order).cast("long").alias("risk_dense_rank"),
    ).orderBy("risk_rank", "merchant_id")


# RPT-5 -----------------------------------------------------------------------
def _pattern_buckets(processed: DataFrame, bucket_sec: int) -> DataFrame:
    """Per (account, bucket): in-bucket flag counts and the first/last rows' values."""
    rows = processed.select(
        "account_id", "transaction_id", "ts", "amount", "transaction_type", "risk_score",
        F.floor(epoch_seconds(F.col("ts")) / F.lit(bucket_sec)).alias("bucket"),
    )
    w = Window.partitionBy("account_id", "bucket").orderBy("ts", "transaction_id")
    amount, prev, nxt = F.col("amount"), F.col("prev_amount"), F.col("next_amount")
    flagged = rows.select(
        "account_id", "bucket", "amount", "transaction_type", "risk_score",
        F.lag("amount", 1).over(w).alias("prev_amount"),
        F.lead("amount", 1).over(w).alias("next_amount"),
        F.lag("transaction_type", 1).over(w).alias("prev_type"),
        F.row_number().over(w).alias("rn"),
        F.lead(F.lit(1), 1).over(w).isNull().alias("is_last"),
    )
    first, last = F.col("rn") == 1, F.col("is_last")
    return flagged.groupBy("account_id", "bucket").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("risk_score").alias("risk_sum"),
        F.max("risk_score").alias("risk_max"),
        # interior flags: every neighbour they need lies in the bucket
        F.count_if(~first & (F.col("transaction_type") == F.col("prev_type"))).alias("rep"),
        F.count_if(~first & (prev > 0) & (F.abs(amount - prev) > prev * 5)).alias("dev"),
        F.count_if(~first & ~last & (amount > prev) & (nxt > amount)).alias("esc"),
        F.max(F.when(first, amount)).alias("first_amount"),
        F.max(F.when(first, F.col("transaction_type"))).alias("first_type"),
        F.max(F.when(first, nxt)).alias("first_next"),
        F.max(F.when(last, amount)).alias("last_amount"),
        F.max(F.when(last, F.col("transaction_type"))).alias("last_type"),
        F.max(F.when(last, prev)).alias("last_prev"),
    )


def _folded(buckets: DataFrame, group: list[str], order: str) -> DataFrame:
    """One summary per group out of the summaries of its buckets, in order.

    A summary has settled all rows but its first (whose row before is missing) and
    its last (whose row after is missing).  Between neighbouring buckets these
    rows meet, so folding settles them and leaves the group's own first and last;
    the fold is associative and can be repeated over coarser groups.
    """
    w = Window.partitionBy(*group).orderBy(order)
    seen = buckets.select(
        "*",
        F.lag("last_amount", 1).over(w).alias("pb_amount"),
        F.lag("last_type", 1).over(w).alias("pb_type"),
        F.lead("first_amount", 1).over(w).alias("nb_amount"),
        (F.row_number().over(w) == 1).alias("is_first"),
        F.lead(F.lit(1), 1).over(w).isNull().alias("is_last"),
    )
    is_first, is_last, many = F.col("is_first"), F.col("is_last"), F.col("cnt") > 1
    fa, la, pa, na = F.col("first_amount"), F.col("last_amount"), F.col("pb_amount"), F.col("nb_amount")
    first_next = F.when(many, F.col("first_next")).otherwise(na)
    last_prev = F.when(many, F.col("last_prev")).otherwise(pa)

    def flag(c):
        return F.when(F.coalesce(c, F.lit(False)), F.lit(1)).otherwise(F.lit(0))

    # a missing neighbour is NULL, which no comparison satisfies
    rep = flag(~is_first & (F.col("first_type") == F.col("pb_type")))
    dev = flag(~is_first & (pa > 0) & (F.abs(fa - pa) > pa * 5))
    esc = flag(~is_first & (fa > pa) & (first_next > fa)) + flag(many & (la > F.col("last_prev")) & (na > la))
    return seen.groupBy(*group).agg(
        F.sum("cnt").alias("cnt"),
        F.sum("risk_sum").alias("risk_sum"),
        F.max("risk_max").alias("risk_max"),
        F.sum(F.col("rep") + rep).alias("rep"),
        F.sum(F.col("dev") + dev).alias("dev"),
        F.sum(F.col("esc") + esc).alias("esc"),
        F.max(F.when(is_first, fa)).alias("first_amount"),
        F.max(F.when(is_first, F.col("first_type"))).alias("first_type"),
        F.max(F.when(is_first, first_next)).alias("first_next"),
        F.max(F.when(is_last, la)).alias("last_amount"),
        F.max(F.when(is_last, F.col("last_type"))).alias("last_type"),
        F.max(F.when(is_last, last_prev)).alias("last_prev"),
    )


def account_patterns(processed: DataFrame, rules: Rules, k: int = 20) -> DataFrame:
    """Per account: repeated types, escalating amounts, large deviations over the
    account's transactions in (ts, transaction_id) order; accounts with any
    pattern, top k by mean risk score.

    Rows fold into short buckets, buckets into days, days into the account: a
    window partition holds a bucket's rows, a day's buckets or an account's days.
    """
    buckets = _pattern_buckets(processed, rules.pattern_bucket_sec)
    day = F.floor(F.col("bucket") * F.lit(rules.pattern_bucket_sec) / F.lit(86400))
    days = _folded(buckets.withColumn("day", day), ["account_id", "day"], "bucket")
    per_account = _folded(days, ["account_id"], "day")
    # the account's first row has nothing before it, which counts as amount 0
    opening = F.when((F.col("first_amount") > 0) & (F.coalesce("first_next", F.lit(0)) > F.col("first_amount")),
                     F.lit(1)).otherwise(F.lit(0))
    named = per_account.select(
        "account_id",
        F.col("cnt").alias("total_transactions"),
        F.col("rep").alias("repeated_type_count"),
        (F.col("esc") + opening).alias("escalating_count"),
        F.col("dev").alias("deviation_count"),
        F.col("risk_sum").alias("_risk_sum"),
        F.col("risk_max").alias("_risk_max"),
    )
    return (
        named.filter(
            (F.col("repeated_type_count") > 2) | (F.col("escalating_count") > 1) | (F.col("deviation_count") > 0)
        )
        .select(
            "account_id",
            F.col("total_transactions").cast("long").alias("total_transactions"),
            F.col("repeated_type_count").cast("long").alias("repeated_type_count"),
            F.col("escalating_count").cast("long").alias("escalating_count"),
            F.col("deviation_count").cast("long").alias("deviation_count"),
            exact_mean(F.col("_risk_sum"), F.col("total_transactions"), 3).cast(SCORE_TYPE).alias("avg_risk_score"),
            F.round(F.col("_risk_max"), 3).cast(SCORE_TYPE).alias("max_risk_score"),
        )
        .orderBy(F.col("avg_risk_score").desc(), F.col("account_id"))
        .limit(k)
    )
