"""Sinks: keyed writes to partitioned parquet tables."""
