"""Oracle SQL text per registered query key (DuckDB dialect)."""

from __future__ import annotations

from . import oracle as o
from .catalog import FIRST_LOAD_UNTIL, LONG_RULES, SECOND_LOAD_FROM
from .fixture_streams import LATE_EDGES, LATE_EVERY, LATE_REST

_ORACLE_SQL: dict[str, str] = {
    "validate_rows": o.validate_rows_sql(),
    "validation_report": o.validation_report_sql(),
    "error_breakdown": o.error_breakdown_sql(),
    "quarantine": o.quarantine_sql(),
    "dedupe_first": o.dedupe_first_sql(),
    "json_roundtrip": o.json_roundtrip_sql(),
    "enrich": o.enrich_sql(),
    "risk_score": o.risk_score_sql(),
    "daily_settlements": o.daily_settlements_sql(),
    "trailing_hour_count": o.trailing_hour_count_sql(),
    "anomaly_high_frequency": o.alerts_sql("HIGH_FREQUENCY"),
    "anomaly_high_daily_amount": o.alerts_sql("HIGH_DAILY_AMOUNT"),
    "anomaly_rapid_succession": o.alerts_sql("RAPID_SUCCESSION"),
    "anomaly_alerts": o.alerts_sql(),
    "rpt_settlement_summary": o.rpt_settlement_summary_sql(),
    "rpt_top_accounts": o.rpt_top_accounts_sql(),
    "rpt_hourly_risk": o.rpt_hourly_risk_sql(),
    "rpt_merchant_risk": o.rpt_merchant_risk_sql(),
    "rpt_account_patterns": o.rpt_account_patterns_sql(),
    "insert_if_absent": o.insert_if_absent_sql(FIRST_LOAD_UNTIL, SECOND_LOAD_FROM),
    "insert_if_absent_indexed": o.insert_if_absent_sql(FIRST_LOAD_UNTIL, SECOND_LOAD_FROM),
    "upsert_settlements": o.upsert_settlements_sql(FIRST_LOAD_UNTIL, SECOND_LOAD_FROM),
    "pipeline_two_batches": o.daily_settlements_sql(),
    "pipeline_two_batches_alerts": o.alerts_sql(),
    "stored_settlement_summary": o.rpt_settlement_summary_sql(),
    "stored_top_accounts": o.rpt_top_accounts_sql(),
    "stored_hourly_risk": o.rpt_hourly_risk_sql(),
    "stored_merchant_risk": o.rpt_merchant_risk_sql(),
    "stored_account_patterns": o.rpt_account_patterns_sql(),
    "pipeline_long_window_alerts": o.long_window_alerts_sql(LONG_RULES.burst_window_sec, LONG_RULES.burst_min_exclusive),
    "quality_log": o.quality_log_sql(),
    "snapshots": o.snapshots_sql(),
    "snapshot_settlements": o.daily_settlements_sql(),
    "quarantine_corrupt": o.quarantine_corrupt_sql(),
    "ordered_settlements": o.ordered_sql("settlement_date, transaction_type", "settlement_date, transaction_type", o.daily_settlements_sql()),
    "ordered_settlement_summary": o.ordered_sql("settlement_date, transaction_type", "settlement_date DESC, transaction_type", o.rpt_settlement_summary_sql()),
    "ordered_hourly_risk": o.ordered_sql("transaction_hour", "transaction_hour", o.rpt_hourly_risk_sql()),
    "ordered_top_accounts": o.ordered_sql("account_id", "total_volume DESC, account_id", o.rpt_top_accounts_sql()),
    "burst_flag": o.burst_flag_sql(),
    "validation_report_json": o.validation_report_json_sql(),
    "stream_dedupe": o.dedupe_first_sql(),
    "stream_quarantine": o.quarantine_sql(),
    "stream_pipeline": o.daily_settlements_sql(),
    "stream_rapid_sessions": o.alerts_sql("RAPID_SUCCESSION"),
    "stream_settlements": o.daily_settlements_sql(),
    "stream_daily_amount": o.alerts_sql("HIGH_DAILY_AMOUNT"),
    "stream_account_alerts": o.alerts_sql(),
    "stream_keyed_alerts": o.alerts_sql("HIGH_FREQUENCY"),
    "stream_hopping_frequency": o.hopping_frequency_sql(),
    "stream_burst_flag": o.burst_flag_sql(),
    "stream_quality_log": o.quality_log_sql(),
    "stream_late_rows": o.late_rows_sql(LATE_EDGES, LATE_EVERY, LATE_REST),
}

# Exact DECIMAL result columns, handed out as DOUBLE like the Spark side (catalog.reported).
DECIMAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "validation_report": ("valid_rate",),
    "dedupe_first": ("amount",),
    "enrich": ("amount",),
    "risk_score": ("risk_score",),
    "daily_settlements": ("total_amount", "avg_amount", "running_total", "day_over_day_change"),
    "anomaly_high_frequency": ("total_amount",),
    "anomaly_high_daily_amount": ("total_amount",),
    "anomaly_rapid_succession": ("total_amount",),
    "anomaly_alerts": ("total_amount",),
    "rpt_settlement_summary": ("total_amount", "avg_amount", "running_total", "dod_change", "dod_pct_change"),
    "rpt_top_accounts": ("total_volume", "avg_transaction_amount"),
    "rpt_hourly_risk": ("total_amount", "avg_amount", "anomaly_rate_pct"),
    "rpt_merchant_risk": ("total_volume", "flagged_pct"),
    "rpt_account_patterns": ("avg_risk_score", "max_risk_score"),
    "upsert_settlements": ("total_amount", "avg_amount", "running_total", "day_over_day_change"),
    "stream_dedupe": ("amount",),
    "stream_settlements": ("total_amount", "avg_amount", "running_total", "day_over_day_change"),
    "stream_daily_amount": ("total_amount",),
    "stream_account_alerts": ("total_amount",),
    "stream_rapid_sessions": ("total_amount",),
    "stream_keyed_alerts": ("total_amount",),
    "stream_hopping_frequency": ("total_amount",),
    "stream_late_rows": ("amount",),
    "pipeline_long_window_alerts": ("total_amount",),
    "snapshots": ("amount", "risk_score"),
    "snapshot_settlements": ("total_amount", "avg_amount", "running_total", "day_over_day_change"),
    "stream_pipeline": ("total_amount", "avg_amount", "running_total", "day_over_day_change"),
    "pipeline_two_batches": ("total_amount", "avg_amount", "running_total", "day_over_day_change"),
    "pipeline_two_batches_alerts": ("total_amount",),
    "stored_settlement_summary": ("total_amount", "avg_amount", "running_total", "dod_change", "dod_pct_change"),
    "stored_top_accounts": ("total_volume", "avg_transaction_amount"),
    "stored_hourly_risk": ("total_amount", "avg_amount", "anomaly_rate_pct"),
    "stored_merchant_risk": ("total_volume", "flagged_pct"),
    "stored_account_patterns": ("avg_risk_score", "max_risk_score"),
}


def _reported(name: str, sql: str) -> str:
    cols = DECIMAL_COLUMNS.get(name)
    if not cols:
        return sql
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) AS reported"


ORACLE_SQL: dict[str, str] = {name: _reported(name, sql) for name, sql in _ORACLE_SQL.items()}
