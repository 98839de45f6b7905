"""Account-level anomaly rules: HIGH_FREQUENCY, HIGH_DAILY_AMOUNT, RAPID_SUCCESSION.

Scale design
------------
A per-account window puts every row of an account into one task; one hot
account holding a third of 100 TB would then sort terabytes in a single task.
Both time-based rules only depend on how many rows (and which amounts) fall on
each whole second, so they are computed from a per-(account, second) histogram
instead:

1. ``groupBy(account_id, sec)`` with map-side partial aggregation: the shuffle
   carries at most one row per (account, second) per task, whatever the skew.
2. The histogram is bucketed by whole days; rows in the last ``halo`` seconds
   of a bucket are also copied into the next bucket.  A trailing window of
   ``halo`` seconds evaluated inside (account, bucket) is then exact for the
   bucket's own rows, and each window partition holds at most
   2 x (86,400 + halo) rows, independent of data volume: every second enters
   the running count and leaves it once (see ``profile_of``).

Semantics equal a per-row window over (ts, transaction_id) order:

* HIGH_FREQUENCY: trailing count over [sec - 3600, sec] (both ends inclusive,
  same-second peers included) > 10; count = max trailing count, amount = sum of
  the amounts of the rows whose own trailing count is over the limit.
* RAPID_SUCCESSION: gap in whole seconds to the previous row < 30; within a
  second every row but the first has gap 0, the first row's gap is to the
  previous non-empty second; count and amount are over the later row of
  each close pair.
* HIGH_DAILY_AMOUNT: account-day amount sum > 50,000, one alert per day.

``detect_anomalies`` evaluates all three in one pipeline over the profile
(account-second -> account-day -> account), so the rows are de-duplicated and
histogrammed once; the single-rule functions are the same rules on their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import HIGH_DAILY_AMOUNT, HIGH_FREQUENCY, RAPID_SUCCESSION, Rules
from ..functions import alert_text
from ..functions.parsing import epoch_seconds
from ..schema import ALERT_COLUMNS, MONEY_SUM_TYPE

DAY_SEC = 86_400


def with_epoch(processed: DataFrame) -> DataFrame:
    return processed.withColumn("sec", epoch_seconds(F.col("ts")))


def second_histogram(processed: DataFrame) -> DataFrame:
    """(account_id, sec) -> n rows, amount sum, amount of the first row in (ts, id) order."""
    return (
        with_epoch(processed)
        .groupBy("account_id", "sec")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount").alias("amt"),
            F.min_by("amount", F.struct("ts", "transaction_id")).alias("first_amt"),
        )
    )


def _halo_bucketed(hist: DataFrame, halo: int, bucket_sec: int) -> DataFrame:
    """Each histogram row in its home bucket, plus a copy in the next bucket
    when it lies within ``halo`` seconds of its bucket's end."""
    bucket = F.floor(F.col("sec") / F.lit(bucket_sec))
    home = F.struct(bucket.alias("bucket"), F.lit(True).alias("is_home"))
    spill = F.when(
        F.col("sec") >= (bucket + 1) * F.lit(bucket_sec) - F.lit(halo),
        F.struct((bucket + 1).alias("bucket"), F.lit(False).alias("is_home")),
    )
    copies = F.filter(F.array(home, spill), lambda x: x.isNotNull())
    return hist.select("*", F.explode(copies).alias("_b")).select("*", "_b.bucket", "_b.is_home").drop("_b")


def second_profile(processed: DataFrame, rules: Rules) -> DataFrame:
    """Per (account, second): n, amt, first_amt, trailing_n (window count), prev_sec."""
    return profile_of(second_histogram(processed), rules)


def profile_of(histogram: DataFrame, rules: Rules) -> DataFrame:
    """The profile of an (account, second) histogram, from wherever that was kept.

    A trailing count is a running sum: a second's rows enter at the second and leave
    (with the sign turned) one second after the look-back ends.  Frames that only grow
    cost the same for every row, where a frame that slides adds up its whole look-back
    anew for each, which is quadratic in a busy account's seconds.
    """
    halo = max(rules.burst_window_sec, rules.rapid_gap_sec)
    bucket_sec = max(rules.histogram_bucket_sec, halo)
    rows = _halo_bucketed(histogram, halo, bucket_sec)
    leaves = F.col("sec") + F.lit(rules.burst_window_sec + 1)
    enter = F.struct(F.col("sec").alias("at"), F.col("n").alias("delta"), F.lit(True).alias("is_row"))
    leave = F.when(leaves < (F.col("bucket") + 1) * F.lit(bucket_sec),
                   F.struct(leaves.alias("at"), (-F.col("n")).alias("delta"), F.lit(False).alias("is_row")))
    steps = rows.select("*", F.explode(F.filter(F.array(enter, leave), lambda x: x.isNotNull())).alias("_s")).select(
        "account_id", "bucket", "_s.at", "_s.delta", "_s.is_row", (F.col("is_home") & F.col("_s.is_row")).alias("is_home"),
        *[F.when(F.col("_s.is_row"), F.col(c)).alias(c) for c in ("n", "amt", "first_amt")])
    # a second's leaving sorts before the second that it leaves at
    ordered = Window.partitionBy("account_id", "bucket").orderBy("at", "is_row")
    upto = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return (
        steps.select(
            "account_id", F.col("at").alias("sec"), "n", "amt", "first_amt", "is_home",
            F.sum("delta").over(upto).alias("trailing_n"),
            F.max(F.when(F.col("is_row"), F.col("at"))).over(ahead).alias("prev_sec"),
        )
        .filter(F.col("is_home"))
        .drop("is_home")
    )


def _alert(df: DataFrame, alert_type: str, description, alert_date=None) -> DataFrame:
    return df.select(
        "account_id",
        F.lit(alert_type).alias("alert_type"),
        description.alias("alert_description"),
        F.col("transaction_count").cast("long").alias("transaction_count"),
        F.col("total_amount").cast(MONEY_SUM_TYPE).alias("total_amount"),
        (alert_date if alert_date is not None else F.lit(None).cast("date")).alias("alert_date"),
    )


def high_frequency(processed: DataFrame, rules: Rules, profile: DataFrame | None = None) -> DataFrame:
    profile = profile if profile is not None else second_profile(processed, rules)
    hot = (
        profile.filter(F.col("trailing_n") > rules.burst_min_exclusive)
        .groupBy("account_id")
        .agg(F.max("trailing_n").alias("transaction_count"), F.sum("amt").alias("total_amount"))
    )
    return _alert(hot, HIGH_FREQUENCY, alert_text.high_frequency(F.col("transaction_count"), rules))


def high_daily_amount(processed: DataFrame, rules: Rules) -> DataFrame:
    """One alert per account-day whose amount sum exceeds the limit (date kept as alert_date).

    A partial aggregate on (account, date): a hot account costs one row per day per task.
    """
    days = (
        processed.groupBy("account_id", "transaction_date")
        .agg(F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"))
        .filter(F.col("total_amount") > rules.daily_amount_limit)
    )
    return _alert(days, HIGH_DAILY_AMOUNT, alert_text.high_daily_amount(F.col("total_amount"), rules),
                  F.col("transaction_date"))


def rapid_succession(processed: DataFrame, rules: Rules, profile: DataFrame | None = None) -> DataFrame:
    profile = profile if profile is not None else second_profile(processed, rules)
    close_n, close_amt = _close_pairs(profile, rules)
    close = profile.select("account_id", close_n.alias("close_n"), close_amt.alias("close_amt")).filter(
        F.col("close_n") > 0)
    per_account = close.groupBy("account_id").agg(
        F.sum("close_n").alias("transaction_count"), F.sum("close_amt").alias("total_amount")
    )
    return _alert(per_account, RAPID_SUCCESSION, alert_text.rapid_succession(F.col("transaction_count"), rules))


def _close_pairs(profile: DataFrame, rules: Rules):
    """(close_n, close_amt) of a profile row: rows that are the later one of a close pair."""
    gap_ok = F.coalesce((F.col("sec") - F.col("prev_sec")) < rules.rapid_gap_sec, F.lit(False))
    close_n = F.col("n") - 1 + F.when(gap_ok, F.lit(1)).otherwise(F.lit(0))
    close_amt = F.col("amt") - F.col("first_amt") + F.when(gap_ok, F.col("first_amt")).otherwise(F.lit(0))
    return close_n, close_amt


def account_days(profile: DataFrame, rules: Rules) -> DataFrame:
    """Per (account, day): day totals and the day's part of the two time rules.

    Sums and maxima over days give an account's alerts, so a day can be worked
    out again on its own (its profile needs the look-back into the day before).
    """
    over = F.col("trailing_n") > rules.burst_min_exclusive
    close_n, close_amt = _close_pairs(profile, rules)
    day = F.date_from_unix_date(F.floor(F.col("sec") / F.lit(DAY_SEC)).cast("int"))
    return profile.groupBy("account_id", day.alias("day")).agg(
        F.sum("amt").alias("day_amt"),
        F.sum("n").alias("day_n"),
        F.max(F.when(over, F.col("trailing_n"))).alias("hf_max"),
        F.sum(F.when(over, F.col("amt"))).alias("hf_amt"),
        F.sum(close_n).alias("rs_n"),
        F.sum(close_amt).alias("rs_amt"),
    )


def alerts_from_days(per_day: DataFrame, rules: Rules) -> DataFrame:
    """Per account: the rule totals plus the list of days over the daily limit (at
    most one entry per calendar day), then one explode into alert rows."""
    big_day = F.when(
        F.col("day_amt") > rules.daily_amount_limit,
        F.struct(F.col("day").alias("d"), F.col("day_amt").alias("a"), F.col("day_n").alias("n")),
    )
    per_account = per_day.groupBy("account_id").agg(
        F.max("hf_max").alias("hf_max"),
        F.sum("hf_amt").alias("hf_amt"),
        F.sum("rs_n").alias("rs_n"),
        F.sum("rs_amt").alias("rs_amt"),
        F.collect_list(big_day).alias("big_days"),
    )

    def alert(kind, count, amount, text, date):
        return F.struct(
            F.lit(kind).alias("alert_type"),
            text.alias("alert_description"),
            count.cast("long").alias("transaction_count"),
            amount.cast(MONEY_SUM_TYPE).alias("total_amount"),
            date.alias("alert_date"),
        )

    no_date = F.lit(None).cast("date")
    hf = F.when(F.col("hf_max").isNotNull(), alert(
        HIGH_FREQUENCY, F.col("hf_max"), F.col("hf_amt"), alert_text.high_frequency(F.col("hf_max"), rules), no_date))
    rs = F.when(F.col("rs_n") > 0, alert(
        RAPID_SUCCESSION, F.col("rs_n"), F.col("rs_amt"), alert_text.rapid_succession(F.col("rs_n"), rules), no_date))
    days = F.transform("big_days", lambda x: alert(
        HIGH_DAILY_AMOUNT, x["n"], x["a"], alert_text.high_daily_amount(x["a"], rules), x["d"]))
    alerts = F.filter(F.concat(F.array(hf, rs), days), lambda x: x.isNotNull())
    return per_account.select("account_id", F.explode(alerts).alias("a")).select(
        "account_id", "a.*").select(*ALERT_COLUMNS)


def account_totals(per_day: DataFrame) -> DataFrame:
    """Per account: what the two time rules need of all its days."""
    return per_day.groupBy("account_id").agg(
        F.max("hf_max").alias("hf_max"), F.sum("hf_amt").alias("hf_amt"), F.sum("rs_n").alias("rs_n"), F.sum("rs_amt").alias("rs_amt"))


def alerts_of_totals(totals: DataFrame, rules: Rules) -> DataFrame:
    """HIGH_FREQUENCY and RAPID_SUCCESSION alerts of ``account_totals`` rows."""
    hf = totals.where("hf_max IS NOT NULL").select("account_id", F.col("hf_max").alias("transaction_count"), F.col("hf_amt").alias("total_amount"))
    rs = totals.where("rs_n > 0").select("account_id", F.col("rs_n").alias("transaction_count"), F.col("rs_amt").alias("total_amount"))
    return _alert(hf, HIGH_FREQUENCY, alert_text.high_frequency(F.col("transaction_count"), rules)).unionByName(
        _alert(rs, RAPID_SUCCESSION, alert_text.rapid_succession(F.col("transaction_count"), rules)))


def alerts_of_days(per_day: DataFrame, rules: Rules) -> DataFrame:
    """HIGH_DAILY_AMOUNT alerts of (account, day) rows."""
    big = per_day.where(F.col("day_amt") > rules.daily_amount_limit).select(
        "account_id", F.col("day_n").alias("transaction_count"), F.col("day_amt").alias("total_amount"), "day")
    return _alert(big, HIGH_DAILY_AMOUNT, alert_text.high_daily_amount(F.col("total_amount"), rules), F.col("day"))


def detect_anomalies(processed: DataFrame, rules: Rules) -> DataFrame:
    """All three rules in one pipeline, same rows as the union of the single-rule outputs.

    profile (per account-second) -> per (account, day) -> per account.  No branch
    re-reads the rows, so the de-duplication and histogram shuffles run once.
    """
    return alerts_from_days(account_days(second_profile(processed, rules), rules), rules)


def trailing_hour_count(processed: DataFrame, rules: Rules) -> DataFrame:
    """Per transaction: number of the account's transactions in [sec - 3600, sec].

    The count comes from the histogram profile and is joined back on
    (account_id, sec); that join key spreads a hot account over all its seconds.
    """
    profile = second_profile(processed, rules).select(
        "account_id", "sec", F.col("trailing_n").alias("txn_count_1h")
    )
    return (
        with_epoch(processed)
        .select("transaction_id", "account_id", "ts", "sec")
        .join(profile, ["account_id", "sec"], "inner")
        .select("transaction_id", "account_id", "ts", "txn_count_1h")
    )
