"""Landing transactions derived from the driver's ``events`` table.

The test tables carry no transaction feed, so this view turns every event into
one landing record (plus redelivered copies and malformed fields) by fixed
arithmetic rules on ``event_id``.  The text is plain SQL that Spark and DuckDB
both run unchanged; Spark gets it through ``spark.sql`` with the events
DataFrame bound as ``{events}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed test-input rules (same text in the Spark plan and the DuckDB oracle).
LANDING_VIEW_SQL = """
WITH base AS (
  SELECT event_id, ts, user_id, event_type, value FROM {events}
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value FROM {events} WHERE event_id % 100 = 7
)
SELECT
  CASE WHEN event_id % 211 = 0 THEN NULL
       WHEN event_id % 223 = 0 THEN 'not-a-uuid'
       ELSE concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS STRING), 12, '0')) END AS transaction_id,
  CASE WHEN event_id % 307 = 0 THEN 'WRONG_FORMAT'
       ELSE concat('ACC_', lpad(CAST(CASE WHEN user_id % 3 < 2 THEN 1 ELSE user_id + 2 END AS STRING), 5, '0')) END AS account_id,
  CASE WHEN event_id % 401 = 0 THEN 'INVALID_TYPE'
       WHEN event_type = 'click' THEN 'WAGER_PLACEMENT'
       WHEN event_type = 'view' THEN 'WAGER_SETTLEMENT'
       WHEN event_type = 'signup' THEN 'ACCOUNT_DEPOSIT'
       WHEN event_type = 'error' THEN 'FEE_CHARGE'
       WHEN event_id % 2 = 0 THEN 'REFUND'
       ELSE 'ACCOUNT_WITHDRAWAL' END AS transaction_type,
  CASE WHEN event_id % 331 = 0 THEN '-50.00'
       WHEN event_id % 337 = 0 THEN 'abc'
       WHEN event_id % 347 = 0 THEN '150000.00'
       WHEN event_id % 50 = 3 THEN CAST(CAST(50000 + value * 20 AS DECIMAL(12,2)) AS STRING)
       ELSE CAST(CAST(value * 20 AS DECIMAL(12,2)) AS STRING) END AS amount,
  CASE WHEN event_id % 353 = 0 THEN 'TOOLONG' ELSE 'USD' END AS currency,
  CASE WHEN event_id % 359 = 0 THEN 'not-a-timestamp'
       WHEN event_id % 367 = 0 THEN '2999-01-01T00:00:00'
       ELSE replace(CAST(ts AS STRING), ' ', 'T') END AS timestamp,
  concat('MER_', lpad(CAST((event_id * 7919) % 500 + 1 AS STRING), 4, '0')) AS merchant_id,
  CASE event_id % 4 WHEN 0 THEN 'New York' WHEN 1 THEN 'Chicago' WHEN 2 THEN 'Houston' ELSE 'Phoenix' END AS location,
  CASE WHEN event_id % 20 = 0 THEN 'FAILED' WHEN event_id % 10 = 1 THEN 'PENDING' ELSE 'COMPLETED' END AS status,
  event_id % 50 = 3 AS is_flagged
FROM base
"""

# The "now" used by the future-timestamp rule on this fixture.
FIXTURE_AS_OF = "2025-01-01 00:00:00"


def landing_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """All-string landing records built from an ``events`` DataFrame."""
    cols = events.select("event_id", "ts", "user_id", "event_type", "value")
    return spark.sql(LANDING_VIEW_SQL, events=cols)


def read_landing_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_from_events(spark, spark.read.parquet(f"{sf_dir}/events.parquet"))
